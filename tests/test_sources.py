import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from trendmill.operators.cleanse import cleanse_live
from trendmill.operators.flatten import flatten_categories, flatten_videos
from trendmill.plans.pipeline import run_backfill
from trendmill.schemas import CORRUPT
from trendmill.sources.bronze_csv import read_backfill, read_backfill_groups
from trendmill.sources import bronze_json
from trendmill.sources.bronze_json import GZIP_FILES, read_live, read_reference, write_bronze
from trendmill.sources.tables import overwrite_partitions, write_full

HEADER = ("video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count,"
          "thumbnail_link,comments_disabled,ratings_disabled,video_error_or_removed,description\n")


def csv_line(vid, date, title, channel, cat, views, likes, dislikes, comments, com="False", rat="False", text="d"):
    return f'{vid},{date},{title},{channel},{cat},2017-11-13T17:13:01.000Z,a|b,{views},{likes},{dislikes},{comments},t,{com},{rat},False,{text}\n'


US = HEADER + "".join([
    csv_line("v1", "17.14.11", '"He said ""hi"", ok"', "ChanA", 10, 1000, 50, 5, 10, text='"line one\nline ""two"", more\n\nend"'),
    csv_line("v2", "17.14.11", "T2", "ChanA", 24, 0, 7, 0, 1),
    csv_line("v3", "17.31.02", "T3", "ChanB", 99, 200, "", "", "", "True"),
    csv_line("", "17.14.11", "blank", "ChanB", 10, 1, 1, 1, 1),
    csv_line("v1", "17.14.11", "dup later", "ChanA", 10, 1200, 60, 5, 10),
    csv_line("v4", "2018-01-05", "iso", "ChanB", "", 500, 1.9, 0, "abc", "False", "maybe"),
])
GB = HEADER + csv_line("v1", "17.14.11", "gb", "ChanA", 10, 300, 3, 0, 0) + csv_line("v5", "junk", "gb2", "ChanC", 24, 100, 10, 0, 5)


def write_files(root, files):
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(root)


@pytest.fixture
def csv_root(tmp_path):
    return write_files(tmp_path / "csv", {"region=US/a.csv": US, "region=gb/b.csv": GB})


def golden(table):
    columns = ["region", "video_id", "title", "trending_date_parsed", "category_id", "views", "likes", "dislikes",
               "comment_count", "comments_disabled", "ratings_disabled", "like_ratio", "engagement_rate"]
    return [tuple(r) for r in table.select(columns).orderBy("region", "video_id").collect()]


NOV, JAN = dt.date(2017, 11, 14), dt.date(2018, 1, 5)
GOLDEN = [
    ("gb", "v1", "gb", NOV, 10, 300, 3, 0, 0, False, False, 1.0, 1.0),
    ("gb", "v5", "gb2", None, 24, 100, 10, 0, 5, False, False, 10.0, 15.0),
    ("us", "v1", "dup later", NOV, 10, 1200, 60, 5, 10, False, False, 5.0, 6.25),
    ("us", "v2", "T2", NOV, 24, 0, 7, 0, 1, False, False, 0.0, 0.0),
    ("us", "v3", "T3", None, 99, 200, 0, 0, 0, True, False, 0.0, 0.0),
    ("us", "v4", "iso", JAN, None, 500, 1, 0, 0, False, None, 0.2, 0.2),
]


def test_backfill_golden_and_rerun(spark, layout, csv_root):
    for counts in ({"files_read": 2, "rows_read": 8, "rows_landed": 7}, {"files_read": 0, "rows_read": 0, "rows_landed": 0}):
        assert run_backfill(spark, csv_root, layout) == counts
        assert golden(spark.table(layout.statistics)) == GOLDEN


def test_backfill_region_argument(spark, layout, csv_root):
    run_backfill(spark, csv_root, layout, regions=[" US"])
    assert golden(spark.table(layout.statistics)) == GOLDEN[2:]
    run_backfill(spark, csv_root, layout, regions={"gb"})
    assert golden(spark.table(layout.statistics)) == GOLDEN


def test_backfill_of_nothing_writes_nothing(spark, layout, tmp_path):
    assert run_backfill(spark, str(tmp_path / "absent"), layout) == {"files_read": 0, "rows_read": 0, "rows_landed": 0}
    assert not spark.catalog.tableExists(layout.statistics)


def test_csv_with_another_column_order_fails_instead_of_swapping(spark, tmp_path):
    write_files(tmp_path, {"one/region=us/a.csv": "video_id,views\na,1\n", "one/region=us/b.csv": "views,video_id\n2,b\n"})
    with pytest.raises(Exception):
        read_backfill(spark, str(tmp_path / "one")).collect()
    write_files(tmp_path, {"two/region=us/a.csv": "video_id,views\na,1\n", "three/region=us/b.csv": "likes,video_id\n2,b\n"})
    rows = read_backfill_groups(spark, [str(tmp_path / "two"), str(tmp_path / "three")])
    assert sorted((r.video_id, r.views, r.likes) for r in rows.collect()) == [("a", "1", None), ("b", None, "2")]


def test_short_csv_rows_are_kept_and_marked(spark, tmp_path):
    path = write_files(tmp_path, {"region=us/a.csv": "video_id,title,views\na,t,1\nb\nc,t,2,extra\n"})
    rows = read_backfill(spark, path, keep_corrupt=True).collect()
    assert {(r.video_id, r.views, r[CORRUPT] is not None) for r in rows} == {("a", "1", False), ("b", None, True), ("c", "2", True)}


def test_region_falls_back_to_the_file_name(spark, tmp_path):
    path = write_files(tmp_path, {"region=us/a.csv": "video_id\na\n"})
    assert read_backfill(spark, path + "/region=us/a.csv").first().region == "us"


def line(**fields):
    return json.dumps(fields, ensure_ascii=False) + "\n"


def test_live_values_are_read_one_by_one(spark, tmp_path):
    path = write_files(tmp_path, {"region=us/date=2024-05-01/hour=10/a.json": (
        line(video_id="a", views="x", likes=1.5, dislikes="3", comment_count=2, region="XX",
             _ingested_at="2024-05-01T10:00:00+00:00", title="é")
        + "\n   \n{bad\n" + line(video_id="b", views=7, _ingested_at="nonsense") + line(title="no id"))})
    rows = {r.video_id: r for r in cleanse_live(read_live(spark, path), "t").collect()}
    assert set(rows) == {"a", "b"}
    a, b = rows["a"], rows["b"]
    assert (a.views, a.likes, a.dislikes, a.comment_count, a.like_ratio, a.engagement_rate) == (0, 1, 3, 2, 0.0, 0.0)
    assert (a.region, a.title, a.trending_date, a.trending_date_parsed) == ("us", "é", "2024-05-01", dt.date(2024, 5, 1))
    assert (a.category_id, a.comments_disabled, a.ratings_disabled) == (0, False, False)
    assert (b.views, b.trending_date, b.trending_date_parsed) == (7, None, None)
    kept = cleanse_live(read_live(spark, path), "t", missing_category=None).filter("video_id = 'a'").first()
    assert kept.category_id is None


def test_one_bad_line_drops_its_file_on_request(spark, tmp_path):
    path = write_files(tmp_path, {
        "region=us/date=2024-05-01/a.json": line(video_id="a") + "{bad\n" + line(video_id="b"),
        "region=us/date=2024-05-01/b.json": line(video_id="c"),
        "region=us/date=2024-05-01/c.txt": line(video_id="ignored"),
    })
    assert sorted(r.video_id for r in read_live(spark, path, "drop_file").collect()) == ["c"]
    kept = read_live(spark, path, keep_corrupt=True).collect()
    assert sorted(r.video_id or "" for r in kept) == ["", "a", "b", "c"]
    assert [r[CORRUPT] for r in kept if r[CORRUPT]] == ["{bad"]


@pytest.mark.parametrize("mode", ["drop_line", "drop_file"])
def test_unreadable_files(spark, tmp_path, mode):
    path = write_files(tmp_path, {"region=us/a.json": line(video_id="a"), "region=us/b.json.gz": "this is no archive"})
    with pytest.raises(Exception):
        read_live(spark, path, mode, files="*.json*").collect()
    rows = read_live(spark, path, mode, files="*.json*", skip_unreadable=True)
    assert [r.video_id for r in rows.collect()] == ["a"]


def test_absent_folders_give_no_rows(spark, tmp_path):
    for read in (read_live, read_reference):
        for mode in ("drop_line", "drop_file"):
            assert read(spark, str(tmp_path / "absent"), mode).isEmpty()


def _payload(spark, items):
    return spark.createDataFrame([("US ", "2024-05-01T00:00:00+00:00", json.dumps({"items": items}))],
                                 "region string, _ingested_at string, payload string")


def test_flatten_videos(spark):
    rows = flatten_videos(_payload(spark, [
        {"id": "a", "snippet": {"tags": ["x", "y"], "categoryId": "10", "channelId": "c"},
         "statistics": {"viewCount": "5", "likeCount": "2", "commentCount": "1"}},
        {"id": "b", "snippet": {"tags": []}, "statistics": {"viewCount": "5"}},
        {"id": "c"},
        {"id": "d", "statistics": {"likeCount": None, "commentCount": "x"}},
    ])).orderBy("video_id").collect()
    assert [(r.tags, r.views, r.likes, r.comment_count, r.comments_disabled, r.ratings_disabled, r.category_id) for r in rows] == [
        ("x|y", 5, 2, 1, False, False, 10), (None, 5, 0, 0, True, True, 0), (None, 0, 0, 0, True, True, 0),
        (None, 0, 0, 0, False, False, 0)]
    assert {(r.region, r.dislikes) for r in rows} == {("us", 0)}


def test_flatten_categories(spark):
    rows = flatten_categories(_payload(spark, [{"id": "10", "snippet": {"title": "Music"}}, {"id": "x1"}, {}]))
    assert [(r.category_id, r.category_name) for r in rows.collect()] == [(10, "Music"), (None, None), (None, None)]


def test_bronze_write_and_read_back(spark, tmp_path):
    rows = flatten_videos(_payload(spark, [{"id": "ü", "statistics": {"viewCount": "5"}}]))
    path = str(tmp_path / "live")
    for run in ("one", "two", "two"):  # every run has its files, a repeated one replaces them
        write_bronze(rows, path, "2024-05-01T09:30:00+00:00", run_id=run)
    files = list((tmp_path / "live").glob("region=us/date=2024-05-01/hour=09/run=*/*.json"))
    assert len(files) == 2
    text = files[0].read_text(encoding="utf-8")
    assert '"ü"' in text and '"tags":null' in text
    assert {(r.video_id, r.views, r.region) for r in read_live(spark, path).collect()} == {("ü", "5", "us")}


def test_compressed_bronze_is_small_bounded_and_replaced(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze_json, "RECORDS_PER_GZIP", 400)
    path, plain = tmp_path / "live", tmp_path / "plain"
    rows = flatten_videos(_payload(spark, [{"id": f"ü{i}", "statistics": {"viewCount": str(i)}} for i in range(1000)]))
    for wanted in (rows, rows, rows.filter("views > 99")):
        write_bronze(wanted, str(path), "2024-05-01T09:30:00+00:00", compression="gzip")
    write_bronze(rows, str(plain), "2024-05-01T09:30:00+00:00")
    files = list(path.rglob("*.json.gz"))
    assert len(files) >= 3 and not list(path.rglob("*.json"))
    assert 10 * sum(f.stat().st_size for f in files) < sum(f.stat().st_size for f in plain.rglob("*.json"))
    found = read_live(spark, str(path), files=GZIP_FILES).select("video_id", "views", "region", "tags")
    assert sorted(map(tuple, found.collect())) == sorted((f"ü{i}", str(i), "us", None) for i in range(100, 1000))


def test_partition_overwrite_leaves_other_partitions(spark, layout):
    where = layout.table("t"), layout.path("t")
    first = spark.createDataFrame([(1, "us"), (2, "gb"), (3, None)], "v long, region string")
    overwrite_partitions(first, *where)
    overwrite_partitions(spark.createDataFrame([(9, "new", "us")], "v long, extra string, region string"), *where)
    assert sorted(map(tuple, spark.table(where[0]).select("v", "extra", "region").collect()), key=str) == [
        (2, None, "gb"), (3, None, None), (9, "new", "us")]
    write_full(first.filter("v = 2"), *where)
    assert [tuple(r) for r in spark.table(where[0]).collect()] == [(2, None, "gb")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_write_is_snappy_parquet_by_region(spark, layout, tmp_path):
    write_full(spark.range(3).withColumn("region", F.lit("us")), layout.table("t"), layout.path("t"))
    assert list((tmp_path / "tables/t/region=us").glob("*.snappy.parquet"))
