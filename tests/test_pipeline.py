import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from trendmill import session
from trendmill.operators.quality import Rules, check_table, check_tables, verdict
from trendmill.plans.pipeline import (
    build_gold_if_clean, check_silver, run_backfill, run_ingest, run_live_cycle, run_reference,
)
from trendmill.plans import pipeline
from trendmill.sources import gold_parts, landing, ledger, published, tables
from trendmill.streaming import live as live_module
from trendmill.streaming.live import run_live

from test_sources import GB, JAN, NOV, US, line, write_files

AS_OF = dt.datetime(2024, 5, 3, tzinfo=dt.timezone.utc)


def feed(root, name, *rows, hour="10", region="us"):
    text = "".join(r if isinstance(r, str) else line(**r) for r in rows)
    write_files(root, {f"region={region}/date=2024-05-01/hour={hour}/{name}.json": text})


def row(vid, views, at="2024-05-01T10:00:00+00:00", **more):
    return {"video_id": vid, "views": views, "_ingested_at": at, "title": "t", "channel_title": "c", **more}


def silver(spark, layout):
    return sorted((r.region, r.video_id, r.views) for r in spark.table(layout.statistics).collect())


@pytest.mark.parametrize("mode", ["drop_line", "drop_file"])
def test_live_stream(spark, layout, tmp_path, mode):
    live, state = tmp_path / "live", str(tmp_path / "state")
    counts = []
    run = lambda: run_live(spark, str(live), layout, state, mode, on_counts=counts.append)
    feed(live, "a", row("a", 1), row("b", 2))
    feed(live, "z", row("z", 5), "{bad\n", row("y", 6))
    run()
    bad_file = [] if mode == "drop_file" else [("us", "y", 6), ("us", "z", 5)]
    assert silver(spark, layout) == [("us", "a", 1), ("us", "b", 2), *bad_file]
    if mode == "drop_line":
        assert counts == [{"batch_id": 0, "rows_read": 5, "rows_bad": 1, "rows_landed": 4}]

    before = spark.table(layout.statistics).collect()
    run()  # nothing new
    assert sorted(spark.table(layout.statistics).collect()) == sorted(before)

    feed(live, "b", row("a", 9, "2024-05-01T11:00:00+00:00"), hour="11")
    run()
    assert silver(spark, layout) == [("us", "a", 9), ("us", "b", 2), *bad_file]

    feed(live, "c", row("a", 100, "2024-05-01T09:00:00+00:00"), hour="09")  # late: older than what is known
    run()
    assert silver(spark, layout) == [("us", "a", 9), ("us", "b", 2), *bad_file]

    feed(live, "d", row("d", 4), hour="08")  # very late: the file itself is old
    os.utime(live / "region=us/date=2024-05-01/hour=08/d.json", (1_500_000_000, 1_500_000_000))
    run()
    assert silver(spark, layout) == [("us", "a", 9), ("us", "b", 2), ("us", "d", 4), *bad_file]


def test_batches_of_a_run_share_one_rebuild(spark, layout, tmp_path, monkeypatch):
    live, state, rebuilt, real = tmp_path / "live", str(tmp_path / "state"), [], landing.rebuild
    for i in range(4):
        feed(live, f"f{i}", row("a", i, f"2024-05-01T1{i}:00:00+00:00"), row(f"b{i}", i, f"2024-0{5 + i % 2}-02T00:00:00+00:00"))

    def counted(session, where, partitions, *rest):
        rebuilt.append(sorted(partitions, key=str))
        real(session, where, partitions, *rest)

    monkeypatch.setattr(landing, "rebuild", counted)
    monkeypatch.setattr(live_module, "rebuild", counted)
    run_live(spark, str(live), layout, state, files_per_batch=1)
    assert rebuilt == [[("us", "2024-05"), ("us", "2024-06")]]
    assert silver(spark, layout) == [("us", "a", 3), *[("us", f"b{i}", i) for i in range(4)]]

    def lost(*_):
        raise RuntimeError("lost")

    feed(live, "g", row("a", 9, "2024-05-01T20:00:00+00:00"), row("n", 7, "no time"), hour="11")
    monkeypatch.setattr(landing, "rebuild", lost)
    with pytest.raises(RuntimeError):  # the batch has landed and counts as done
        run_live(spark, str(live), layout, state)
    monkeypatch.setattr(landing, "rebuild", counted)
    run_live(spark, str(live), layout, state)  # nothing new, but what is behind is made up for
    assert rebuilt[1:] == [[("us", "2024-05"), ("us", None)]]
    assert ("us", "a", 9) in silver(spark, layout) and ("us", "n", 7) in silver(spark, layout)
    run_live(spark, str(live), layout, state)
    assert len(rebuilt) == 2 and not list((tmp_path / "tables/landing/behind").glob("*"))


def test_backfill_and_live_meet_in_one_table(spark, layout, tmp_path):
    run_backfill(spark, write_files(tmp_path / "csv", {"region=US/a.csv": US, "region=gb/b.csv": GB}), layout)
    live = tmp_path / "live"
    feed(live, "a", row("v1", 7, "2017-11-14T05:00:00+00:00"), row("n", 1), row("q", 3, "bad time"))
    run_live(spark, str(live), layout, str(tmp_path / "state"))
    rows = {(r.region, r.video_id, r.trending_date_parsed): r.views for r in spark.table(layout.statistics).collect()}
    assert len(rows) == 8
    assert rows["us", "v1", NOV] == 7 and rows["gb", "v1", NOV] == 300  # the timed row beats the backfill's
    assert rows["us", "q", None] == 3 and rows["us", "v3", None] == 200
    run_backfill(spark, str(tmp_path / "csv"), layout)  # a repeated backfill does not undo live rows
    again = {(r.region, r.video_id, r.trending_date_parsed): r.views for r in spark.table(layout.statistics).collect()}
    assert again == rows


def test_replay_restores_a_lost_partition(spark, layout, tmp_path):
    live = tmp_path / "live"
    feed(live, "a", row("a", 1))
    run_live(spark, str(live), layout, str(tmp_path / "state"))
    feed(live, "b", row("b", 2, "2024-06-01T00:00:00+00:00"), hour="11")
    run_live(spark, str(live), layout, str(tmp_path / "state"))
    want = silver(spark, layout)
    shutil.rmtree(tmp_path / "tables/clean_statistics/region=us/trending_month=2024-06")
    spark.catalog.refreshTable(layout.statistics)
    untouched = tmp_path / "tables/clean_statistics/region=us/trending_month=2024-05"
    files = sorted(p.name for p in untouched.iterdir())
    landing.rebuild(spark, layout, [("us", "2024-06")])
    assert silver(spark, layout) == want
    assert sorted(p.name for p in untouched.iterdir()) == files


# --- quality ----------------------------------------------------------------------------------------


def checks(df, table="clean_statistics", **kwargs):
    rows = check_table(df, table, as_of=F.lit(AS_OF), **kwargs).collect()
    return {(r.check, r.column): r for r in rows}


def stats(spark, n=20, null_titles=0, views="id", extra=()):
    return spark.range(n).selectExpr(
        "cast(id as string) as video_id", f"case when id >= {null_titles} then 't' end as title", "'c' as channel_title",
        f"{views} as views", "'us' as region", *extra)


def test_row_count(spark):
    assert [checks(stats(spark, n))["row_count", None].passed for n in (9, 10)] == [False, True]


def test_null_percentage(spark):
    five, six = (checks(stats(spark, 100, n))["null_pct", "title"] for n in (5, 6))
    assert (five.passed, five.value, six.passed, six.value) == (True, 5.0, False, 6.0)
    assert six.message == "6.00 % of title are empty, 5.0 % allowed"
    assert checks(stats(spark, 0))["null_pct", "title"].value == 0.0


def test_missing_column(spark):
    found = checks(stats(spark).drop("title"))
    assert not found["null_pct", "title"].passed
    assert (found["schema", None].passed, found["schema", None].missing) == (False, ["title"])
    assert checks(stats(spark))["schema", None].missing == []


def test_value_range(spark):
    def of(views):
        return checks(stats(spark, views=views))["value_range", "views"]
    assert (of("if(id = 3, -1, id)").passed, of("if(id = 3, -1, id)").negative) == (False, 1)
    assert of("50000000000L").passed
    assert (of("50000000000L + id % 2").passed, of("50000000000L + id % 2").extreme) == (False, 10)
    assert of("if(id = 0, 'junk', '5')").passed
    assert ("value_range", "views") not in checks(stats(spark), "clean_reference_data")


def test_freshness(spark):
    def of(expression):
        return checks(stats(spark, extra=[f"{expression} as _processed_at"]))["freshness", None].passed
    assert of("timestamp'2024-05-01 01:00:00'") and not of("timestamp'2024-04-30 23:00:00'")
    assert of("if(id = 0, '2024-05-02T00:00:00+00:00', 'bad')") and not of("'bad'")
    assert checks(stats(spark))["freshness", None].passed


def test_unreadable_table_fails_alone(spark, layout):
    tables.write_full(stats(spark), layout.statistics, layout.path("clean_statistics"))
    found = check_tables(spark, {"clean_statistics": layout.statistics, "clean_reference_data": layout.reference})
    assert [(r.check, r.table) for r in found.filter("not passed").collect()] == [("read_table", "clean_reference_data")]
    assert verdict(found).first().asDict() == {"quality_passed": False, "checks_passed": 9, "checks_total": 10}
    assert verdict(found.filter("false")).first().asDict() == {
        "quality_passed": True, "checks_passed": 0, "checks_total": 0}


# --- ingest ------------------------------------------------------------------------------------------


def test_ingest_feeds_the_live_run(spark, layout, tmp_path):
    good = json.dumps({"items": [{"id": "a", "statistics": {"viewCount": "5"}}, {"id": "b"}]})
    names = json.dumps({"items": [{"id": "10", "snippet": {"title": "Music"}}]})
    columns = "region string, payload string"
    report = run_ingest(
        spark.createDataFrame([("US", good), ("GB", '{"items": ['), ("FR", "{}")], columns),
        spark.createDataFrame([("US", names)], columns),
        str(tmp_path / "live"), str(tmp_path / "ref"), "2024-05-01T10:00:00+00:00")
    assert sorted((r.kind, r.region, r.payloads_ok, r.payloads_bad, r["items"], r.succeeded) for r in report.collect()) == [
        ("categories", "us", 1, 0, 1, True), ("trending", "fr", 1, 0, 0, True),
        ("trending", "gb", 0, 1, 0, False), ("trending", "us", 1, 0, 2, True)]
    run_live(spark, str(tmp_path / "live"), layout, str(tmp_path / "state"))
    assert silver(spark, layout) == [("us", "a", 5), ("us", "b", 0)]
    assert run_reference(spark, str(tmp_path / "ref"), layout)
    assert [(r.category_id, r.category_name, r.region) for r in spark.table(layout.reference).collect()] == [(10, "Music", "us")]


# --- whole run --------------------------------------------------------------------------------------


def test_cycle_gate_and_gold(spark, layout, tmp_path):
    run_backfill(spark, write_files(tmp_path / "csv", {"region=US/a.csv": US, "region=gb/b.csv": GB}), layout)
    ref = tmp_path / "ref"
    write_files(ref, {"region=us/date=2024-05-01/us.json":
                      line(category_id=10, category_name="Music", _ingested_at="2024-05-01T00:00:00+00:00")
                      + line(category_id=10, category_name="Musik", _ingested_at="2024-04-01T00:00:00+00:00")
                      + line(category_id=24, category_name="Entertainment") + line(category_id="x", category_name="bad")})
    cycle = lambda rules: run_live_cycle(
        spark, str(tmp_path / "live"), str(ref), layout, str(tmp_path / "state"), rules)
    (tmp_path / "live").mkdir()

    refused = cycle(Rules())
    assert not refused.quality_passed
    assert {(r.check, r.table) for r in refused.failed.collect()} == {
        ("row_count", "clean_statistics"), ("row_count", "clean_reference_data")}
    assert not spark.catalog.tableExists(layout.table("trending_analytics"))

    rules = Rules(min_rows=2)
    passed = cycle(rules)
    assert passed.quality_passed and passed.failed.isEmpty()

    trending = {(r.region, r.trending_date_parsed): r for r in spark.table(layout.table("trending_analytics")).collect()}
    r = trending["us", NOV]
    assert (r.total_videos, r.total_views, r.total_likes, r.total_comments, r.avg_views_per_video, r.avg_like_ratio,
            r.avg_engagement_rate, r.max_views, r.unique_channels, r.unique_categories) == (
        2, 1200, 67, 11, 600.0, 2.5, 3.125, 1200, 1, 2)
    assert set(trending) == {("gb", NOV), ("gb", None), ("us", NOV), ("us", None), ("us", JAN)}
    assert trending["us", JAN].unique_categories == 0

    channels = {(r.region, r.channel_title): (r.total_videos, r.total_views, r.times_trending, r.categories, r.rank_in_region)
                for r in spark.table(layout.table("channel_analytics")).collect()}
    assert channels == {
        ("gb", "ChanA"): (1, 300, 1, ["Music"], 1), ("gb", "ChanC"): (1, 100, 0, ["Entertainment"], 2),
        ("us", "ChanA"): (2, 1200, 2, ["Entertainment", "Music"], 1), ("us", "ChanB"): (2, 700, 1, ["Unknown"], 2)}

    shares = {(r.category_name, r.category_id, r.region, r.trending_date_parsed): r.view_share_pct
              for r in spark.table(layout.table("category_analytics")).collect()}
    assert shares == {
        ("Music", 10, "gb", NOV): 100.0, ("Entertainment", 24, "gb", None): 100.0, ("Music", 10, "us", NOV): 100.0,
        ("Entertainment", 24, "us", NOV): 0.0, ("Unknown", 99, "us", None): 100.0, ("Unknown", None, "us", JAN): 100.0}

    # A later failure leaves the old Gold as it is; a repeated build changes nothing.
    old = sorted(map(str, spark.table(layout.table("channel_analytics")).collect()))
    assert not build_gold_if_clean(spark, layout, Rules(min_rows=1000)).quality_passed
    assert sorted(map(str, spark.table(layout.table("channel_analytics")).collect())) == old
    build_gold_if_clean(spark, layout, rules)
    again = spark.table(layout.table("channel_analytics"))
    assert sorted(map(str, again.drop("_aggregated_at").collect())) == sorted(
        s.split(", _aggregated_at")[0] for s in map(str, again.drop("_aggregated_at").collect()))
    assert again.count() == 4


def test_gold_without_reference_table(spark, layout):
    from trendmill.plans.pipeline import build_gold

    rows = stats(spark, extra=["date'2024-05-01' as trending_date_parsed", "id as category_id", "1L as likes",
                               "0L as comment_count", "1.0D as like_ratio", "1.0D as engagement_rate"])
    tables.write_full(rows, layout.statistics, layout.path("clean_statistics"))
    build_gold(spark, layout)
    assert {r.category_name for r in spark.table(layout.table("category_analytics")).collect()} == {"Unknown"}


def test_empty_reference_writes_nothing(spark, layout, tmp_path):
    assert run_reference(spark, str(tmp_path / "absent"), layout) is False
    assert not spark.catalog.tableExists(layout.reference)


def test_reference_load_replaces_its_regions_without_a_folder_for_each(spark, layout, tmp_path):
    def load(name, *rows):
        text = "".join(json.dumps({"category_id": i, "category_name": n, "region": r, "_ingested_at": "2024-05-01T10:00:00+00:00"}) + "\n"
                       for i, n, r in rows)
        write_files(tmp_path / name, {"names.json": text})
        return run_reference(spark, str(tmp_path / name), layout)

    def names():
        return sorted(((r.region, r.category_id, r.category_name) for r in spark.table(layout.reference).collect()), key=str)

    many = [("1", "old", f"R{i}") for i in range(50)]
    assert load("one", *many, ("2", "gone", "R1"), ("3", "none", None), ("4", "blank", " "))
    assert load("two", ("1", "new", " r1 "), ("5", "none again", None))
    wanted = sorted([*[(f"r{i}", 1, "new" if i == 1 else "old") for i in range(50)], (None, 5, "none again")], key=str)
    assert names() == wanted
    assert not load("nothing", ("x", "no id", "R1")) and names() == wanted
    folder = tmp_path / "tables/clean_reference_data"
    assert not list(folder.glob("**/region=*")) and len(list(folder.glob("**/*.parquet"))) < 50
    spark.sql(f"DROP VIEW {layout.reference}")  # a lost catalog entry hides nothing
    assert load("three", ("1", "newest", "R2"))
    assert names() == sorted([(r, i, "newest" if r == "r2" else n) for r, i, n in wanted], key=str)


def test_reference_load_takes_over_folders_of_regions(spark, layout):
    where = layout.reference, layout.path("clean_reference_data")
    tables.overwrite_partitions(spark.createDataFrame([(1, "a", "x", "us"), (2, "b", "y", "gb")],
                                                      "category_id long, category_name string, note string, region string"), *where)
    new = spark.createDataFrame([(3, "c", "us")], "category_id long, category_name string, region string")
    spark.sql(f"DROP TABLE {layout.reference}")
    for _ in range(2):
        published.merge(new, *where)
        assert {tuple(r) for r in spark.table(layout.reference).collect()} == {(3, "c", None, "us"), (2, "b", "y", "gb")}


def test_fresh_silver_passes_with_default_clock(spark, layout, tmp_path):
    run_backfill(spark, write_files(tmp_path / "csv", {"region=US/a.csv": US, "region=gb/b.csv": GB}), layout)
    result, found = check_silver(spark, layout, Rules(min_rows=1), tables=("clean_statistics",))
    assert result.quality_passed, json.dumps([r.message for r in found.collect()])


# --- tables that stay whole ---------------------------------------------------------------------------


def test_two_feeds_with_checkpoints_of_their_own(spark, layout, tmp_path):
    for name in ("a", "b"):
        feed(tmp_path / name, name, row(name, 1))
        run_live(spark, str(tmp_path / name), layout, str(tmp_path / f"state-{name}"))
    assert silver(spark, layout) == [("us", "a", 1), ("us", "b", 1)]
    shutil.rmtree(tmp_path / "a/region=us/date=2024-05-01/hour=10")  # the old file is gone, and so is the checkpoint
    feed(tmp_path / "a", "c", row("c", 3), hour="11")
    run_live(spark, str(tmp_path / "a"), layout, str(tmp_path / "state-new"))
    assert silver(spark, layout) == [("us", "a", 1), ("us", "b", 1), ("us", "c", 3)]


def test_failing_full_write_leaves_the_old_rows(spark, layout, tmp_path):
    feed(tmp_path / "live", "a", row("a", 1), row("b", 2, "2024-06-01T00:00:00+00:00"))
    run_live(spark, str(tmp_path / "live"), layout, str(tmp_path / "state"))
    want = silver(spark, layout)
    bad = spark.table(layout.statistics).limit(0).unionByName(
        spark.createDataFrame([("x", "us", "2024-05")], "video_id string, region string, trending_month string"),
        allowMissingColumns=True).withColumn("title", F.raise_error(F.lit("half way")).cast("string"))
    with pytest.raises(Exception, match="half way"):
        tables.write_full(bad, layout.statistics, layout.path("clean_statistics"), landing.SILVER_PARTITIONS)
    assert silver(spark, layout) == want
    feed(tmp_path / "live", "c", row("c", 3, "2024-07-01T00:00:00+00:00"), hour="11")
    run_live(spark, str(tmp_path / "live"), layout, str(tmp_path / "state"))
    assert silver(spark, layout) == [*want, ("us", "c", 3)]


@pytest.mark.parametrize("lost", ["statistics", "landing"])
def test_lost_catalog_entry_loses_no_rows(spark, layout, tmp_path, lost):
    feed(tmp_path / "live", "a", row("a", 1), row("b", 2, "2024-06-01T00:00:00+00:00"), row("n", 3, "never"))
    run_live(spark, str(tmp_path / "live"), layout, str(tmp_path / "state"))
    spark.sql(f"DROP TABLE {getattr(layout, lost)}")
    feed(tmp_path / "live", "c", row("c", 3, "2024-06-02T00:00:00+00:00"), hour="11")
    run_live(spark, str(tmp_path / "live"), layout, str(tmp_path / "state"))
    assert silver(spark, layout) == [("us", "a", 1), ("us", "b", 2), ("us", "c", 3), ("us", "n", 3)]


HEAD = "video_id,trending_date,title,channel_title,views\n"


def test_backfills_add_up_and_a_corrected_file_replaces_its_own_rows(spark, layout, tmp_path):
    def load(folder, regions=None, **files):
        path = write_files(tmp_path / folder, {f"region={r}/{r}.csv": HEAD + rows for r, rows in files.items()})
        return run_backfill(spark, path, layout, regions)["files_read"]

    assert load("a", us="v,24.05.01,t,c,500\nw,24.05.02,t,c,5\n") == 1
    assert load("b", gb="v,24.05.01,t,c,600\n", us="v,24.05.01,t,c,100\n") == 2
    want = [("gb", "v", 600), ("us", "v", 500), ("us", "w", 5)]
    assert silver(spark, layout) == want
    assert load("a") == load("b") == 0 and silver(spark, layout) == want
    # Corrected downward, and w's month is gone; the other folder's row of the same key counts now.
    assert load("a", us="v,24.05.01,t,c,90\n") == 1
    assert silver(spark, layout) == [("gb", "v", 600), ("us", "v", 100)]
    assert load("b", us="x,24.05.01,t,c,70\n", gb="v,24.05.01,t,c,601\n", regions=["US"]) == 1  # gb is not asked for
    assert silver(spark, layout) == [("gb", "v", 600), ("us", "v", 90), ("us", "x", 70)]
    assert load("b", us="") == 2  # no row left; and the gb file is taken now
    assert silver(spark, layout) == [("gb", "v", 601), ("us", "v", 90)]
    tables_before = silver(spark, layout)
    landing.rebuild_all(spark, layout)
    assert silver(spark, layout) == tables_before


def test_a_backfill_that_dies_is_taken_again(spark, layout, tmp_path, monkeypatch):
    path = write_files(tmp_path / "a", {"region=us/a.csv": HEAD + "v,24.05.01,t,c,1\nw,24.05.03,t,c,1\n"})
    real = ledger.record
    monkeypatch.setattr(ledger, "record", lambda *_: (_ for _ in ()).throw(RuntimeError("half way")))
    with pytest.raises(RuntimeError, match="half way"):
        run_backfill(spark, path, layout)
    monkeypatch.setattr(ledger, "record", real)
    write_files(tmp_path / "a", {"region=us/a.csv": HEAD + "v,24.05.02,t,c,2\n"})
    run_backfill(spark, path, layout)
    assert silver(spark, layout) == [("us", "v", 2)]
    # The file is gone by the time of the next try: what the dead run left goes away.
    monkeypatch.setattr(ledger, "record", lambda *_: (_ for _ in ()).throw(RuntimeError("half way")))
    more = write_files(tmp_path / "b", {"region=gb/b.csv": HEAD + "z,24.05.02,t,c,9\n"})
    with pytest.raises(RuntimeError, match="half way"):
        run_backfill(spark, more, layout)
    monkeypatch.setattr(ledger, "record", real)
    (tmp_path / "b/region=gb/b.csv").unlink()
    run_backfill(spark, more, layout)
    assert silver(spark, layout) == [("us", "v", 2)]


def test_folding_bounds_the_files_of_a_rebuild(spark, layout, tmp_path):
    live, state = tmp_path / "live", str(tmp_path / "state")
    path = write_files(tmp_path / "a", {"region=us/a.csv": HEAD + "a,24.05.01,t,c,500\n"})
    run_backfill(spark, path, layout)
    for i in range(5):
        feed(live, f"f{i}", row("a", i, "2024-05-01T10:00:00+00:00"), row(f"b{i}", i), hour=f"1{i}")
        run_live(spark, str(live), layout, state)
    want = silver(spark, layout)
    rebuilt = landing.fold(spark, layout, max_batches=2)
    assert rebuilt == [("us", "2024-05")]
    left = [k for k in tables.partition_names(spark, layout.landing) if k[3] == "2024-05"]
    assert sorted(k[0] == landing.FOLDED for k in left) == [False, True]  # the folded one and the open one
    files = list((tmp_path / "tables/landing/statistics").rglob("region=us/trending_month=2024-05/*.parquet"))
    assert len(files) <= 3
    landing.rebuild_all(spark, layout)
    assert silver(spark, layout) == want
    # A closed batch that comes again after all changes nothing.
    run_live(spark, str(live), layout, str(tmp_path / "another"))
    assert silver(spark, layout) == want
    # Corrections reach rows that were folded with others of the same key.
    for views in (400, 300, 200):
        write_files(tmp_path / "a", {"region=us/a.csv": HEAD + f"a,24.05.01,t,c,{views}\nk,24.05.01,t,c,{views}\n"})
        run_backfill(spark, path, layout)
    other = write_files(tmp_path / "o", {"region=us/o.csv": HEAD + "a,24.05.01,t,c,50\n"})
    run_backfill(spark, other, layout)
    assert landing.fold(spark, layout, max_batches=1) == [("us", "2024-01")]
    write_files(tmp_path / "a", {"region=us/a.csv": HEAD})
    run_backfill(spark, path, layout)
    assert [r for r in silver(spark, layout) if r[1] in "ak" and r[2] in (50, 200, 300)] == [("us", "a", 50)]


def test_processed_files_move_to_the_archive(spark, layout, tmp_path):
    live, state, archive = tmp_path / "live", str(tmp_path / "state"), tmp_path / "archive"
    for i in range(3):
        feed(live, f"f{i}", row(f"a{i}", i), hour=f"1{i}")
        run_live(spark, str(live), layout, state, archive=str(archive))
    left = sorted(p.name for p in live.rglob("*.json"))
    moved = sorted(p.name for p in archive.rglob("*.json"))
    assert sorted(left + moved) == ["f0.json", "f1.json", "f2.json"] and len(moved) >= 1
    want = silver(spark, layout)
    spark.sql(f"DROP TABLE {layout.statistics}")
    shutil.rmtree(tmp_path / "tables/clean_statistics")
    run_live(spark, f"{archive}{live}", layout, str(tmp_path / "again"))
    assert silver(spark, layout) == want


# --- publishing -------------------------------------------------------------------------------------


def gold_inputs(spark, layout, n):
    rows = stats(spark, n, extra=["date'2024-05-01' as trending_date_parsed", "id as category_id", "1L as likes",
                                  "0L as comment_count", "1.0D as like_ratio", "1.0D as engagement_rate"])
    rows = rows.withColumn("region", F.when(F.col("video_id") % 2 == 0, F.lit("us")).otherwise(F.lit("gb")))
    tables.write_full(rows, layout.statistics, layout.path("clean_statistics"))


def totals(spark, layout):
    return {name: spark.table(layout.table(f"{name}_analytics")).agg(F.sum("total_views")).first()[0]
            for name in ("trending", "channel", "category")}


@pytest.mark.parametrize("dies", ["write_version", "point_to"])
def test_a_build_that_dies_changes_nothing_for_readers(spark, layout, monkeypatch, dies):
    gold_inputs(spark, layout, 20)
    pipeline.build_gold(spark, layout)
    old = totals(spark, layout)
    gold_inputs(spark, layout, 30)
    real = getattr(pipeline, dies)

    def die(*args):
        if dies == "write_version" and "category" not in args[1]:
            return real(*args)
        raise RuntimeError("before the switch")

    monkeypatch.setattr(pipeline, dies, die)
    with pytest.raises(RuntimeError, match="before the switch"):
        pipeline.build_gold(spark, layout)
    assert totals(spark, layout) == old == dict.fromkeys(old, 190)
    monkeypatch.undo()
    pipeline.build_gold(spark, layout)
    assert totals(spark, layout) == dict.fromkeys(old, 435)


def test_readers_see_one_version_and_old_ones_go(spark, layout):
    name, path = layout.table("trending_analytics"), layout.path("trending_analytics")
    gold_inputs(spark, layout, 20)
    made = [pipeline.build_gold(spark, layout)["trending_analytics"]]
    planned = spark.table(name).select("region", "total_videos")  # a reader that has begun
    for n in (30, 40):
        gold_inputs(spark, layout, n)
        made.append(pipeline.build_gold(spark, layout)["trending_analytics"])
        if n == 30:
            assert {tuple(r) for r in planned.collect()} == {("us", 10), ("gb", 10)}
    assert published.current_version(spark, name) == made[-1] == max(made)
    assert published.versions(spark, path) == made[1:]
    published.point_to(spark, name, made[1])  # back to the version before
    assert {tuple(r) for r in spark.table(name).select("region", "total_videos").collect()} == {("us", 15), ("gb", 15)}
    assert published.remove_old_versions(spark, name, path) == [] and published.versions(spark, path) == made[1:]


def test_a_plain_table_becomes_a_published_one(spark, layout):
    where = layout.table("t"), layout.path("t")
    tables.write_full(spark.createDataFrame([(1, "us"), (2, "gb")], "v long, region string"), *where)
    published.publish(spark.createDataFrame([(3, "us")], "v long, region string"), *where)
    assert [tuple(r) for r in spark.table(where[0]).collect()] == [(3, "us")]
    published.publish(spark.createDataFrame([], "v long, region string"), *where)
    assert spark.table(where[0]).isEmpty()


def test_landing_has_few_files_and_old_months_are_not_opened(spark, layout, tmp_path):
    import datetime

    rows = spark.range(0, 4000, 1, 16).selectExpr(
        "cast(id as string) as video_id", "'us' as region", "id as views",
        "date_add(date'2024-01-01', cast(id % 60 as int)) as trending_date_parsed")
    n, changed = landing.land(rows, layout, "f", 0)
    assert (n, changed) == (4000, [("us", "2024-01"), ("us", "2024-02")])
    files = list((tmp_path / "tables/landing/statistics").rglob("*.parquet"))
    assert len(files) <= 4
    landing.rebuild(spark, layout, changed)
    for file in files:
        file.write_bytes(b"damaged")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    late = rows.limit(5).withColumn("trending_date_parsed", F.lit(datetime.date(2024, 9, 1)))
    _, changed = landing.land(late, layout, "f", 1)
    landing.rebuild(spark, layout, changed)
    assert spark.table(layout.statistics).count() == 4005


def test_a_task_of_a_rebuild_sorts_few_rows(spark, layout, monkeypatch):
    monkeypatch.setattr(tables, "RECORDS_PER_FILE", 500)
    monkeypatch.setattr(session, "SORTED_BYTES", 1024 * 1024)
    rows = spark.range(0, 4000, 1, 3).selectExpr(
        "cast(id as string) as video_id", "'us' as region", "id as views", "date'2024-01-01' as trending_date_parsed")
    _, changed = landing.land(rows, layout, "f", 0)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    read = []

    def seen(landed):
        read.extend(r["count"] for r in landed.groupBy(F.spark_partition_id().alias("task")).count().collect())
        return latest(landed)

    latest = landing.latest_statistics
    monkeypatch.setattr(landing, "latest_statistics", seen)
    spark.catalog.refreshTable(layout.landing)
    landing.rebuild(spark, layout, changed)
    assert sum(read) == 4000 and max(read) <= 500
    assert spark.table(layout.statistics).count() == 4000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_damaged_table_fails_its_own_check_only(spark, layout, tmp_path):
    tables.write_full(stats(spark), layout.statistics, layout.path("clean_statistics"))
    tables.write_full(stats(spark).select("region", F.lit(1).alias("category_id")), layout.reference,
                      layout.path("clean_reference_data"))
    for file in (tmp_path / "tables/clean_reference_data").rglob("*.parquet"):
        file.write_bytes(b"damaged")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    spark.catalog.refreshTable(layout.reference)
    result, found = check_silver(spark, layout)
    assert not result.quality_passed
    assert [(r.check, r.passed) for r in found.filter("table = 'clean_reference_data'").collect()] == [("read_table", False)]
    assert found.filter("table = 'clean_statistics'").count() > 4


# --- Gold from parts --------------------------------------------------------------------------------


def gold_rows(spark, layout):
    names = ("trending_analytics", "channel_analytics", "category_analytics")
    return {n: sorted(map(str, spark.table(layout.table(n)).drop("_aggregated_at").collect())) for n in names}


def same_as_full_build(spark, layout):
    got = gold_rows(spark, layout)
    pipeline.build_gold(spark, layout)
    assert got == gold_rows(spark, layout)


def spoil(folder):
    """Other bytes under the names, sizes and times of a folder's files: whoever opens one fails."""
    for file in folder.glob("*.parquet"):
        was = file.stat()
        file.write_bytes(b"x" * was.st_size)
        os.utime(file, ns=(was.st_atime_ns, was.st_mtime_ns))


def test_refresh_opens_only_changed_months(spark, layout, tmp_path):
    live, state = tmp_path / "live", str(tmp_path / "state")
    run = lambda: run_live(spark, str(live), layout, state)
    feed(live, "a", row("a", 1), row("b", 2, likes=1), row("c", 3, "2024-06-01T00:00:00+00:00"), row("d", 4, "no time"),
         row("e", 5, channel_title=None, category_id="x"))
    run()
    months = [("us", None), ("us", "2024-05"), ("us", "2024-06")]
    assert pipeline.refresh_gold(spark, layout) == sorted(months, key=str)
    same_as_full_build(spark, layout)
    assert pipeline.refresh_gold(spark, layout) == []

    may = tmp_path / "tables/clean_statistics/region=us/trending_month=2024-05"
    kept = tmp_path / "kept"
    shutil.copytree(may, kept)
    spoil(may)
    feed(live, "b", row("c", 30, "2024-06-02T00:00:00+00:00"), row("g", 7, "2024-06-02T00:00:00+00:00"), hour="11")
    run()
    assert pipeline.refresh_gold(spark, layout) == [("us", "2024-06")]
    shutil.rmtree(may)
    shutil.copytree(kept, may)
    spark.catalog.refreshTable(layout.statistics)
    same_as_full_build(spark, layout)


def test_refresh_makes_up_for_what_was_missed(spark, layout, tmp_path, monkeypatch):
    live, state = tmp_path / "live", str(tmp_path / "state")
    feed(live, "a", row("a", 1), row("c", 3, "2024-06-01T00:00:00+00:00"))
    run_live(spark, str(live), layout, state)
    pipeline.refresh_gold(spark, layout)
    feed(live, "b", row("n", 9), hour="11")
    run_live(spark, str(live), layout, state)
    with monkeypatch.context() as broken:  # a run that dies after some parts are written
        real = gold_parts.insert_partitions

        def dies(part, table, *rest):
            if table.endswith("channel_videos"):
                raise RuntimeError("lost")
            return real(part, table, *rest)
        broken.setattr(gold_parts, "insert_partitions", dies)
        with pytest.raises(RuntimeError):
            pipeline.refresh_gold(spark, layout)
    assert pipeline.refresh_gold(spark, layout) == [("us", "2024-05")]
    same_as_full_build(spark, layout)

    shutil.rmtree(tmp_path / "tables/gold_parts/made_from")  # a lost record: all anew
    assert pipeline.refresh_gold(spark, layout) == [("us", "2024-05"), ("us", "2024-06")]
    names = tables.partition_names(spark, layout.statistics)
    tables.drop_partitions(spark, layout.statistics, ("region", "trending_month"),
                           {p: n for p, n in names.items() if p[1] == "2024-06"})
    assert pipeline.refresh_gold(spark, layout) == [("us", "2024-06")]  # a month that is gone
    same_as_full_build(spark, layout)


def test_refresh_wants_silver_by_month(spark, layout):
    rows = spark.createDataFrame([("a", "us")], "video_id string, region string")
    tables.write_full(rows, layout.statistics, layout.path("clean_statistics"), ("region",))
    with pytest.raises(ValueError, match="trending_month"):
        pipeline.refresh_gold(spark, layout)
