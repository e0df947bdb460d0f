"""Mixing sources to target weights: whole copies first, then Pareto order sampling for the rest.

A source's target is its weighted share of all words, bounded by how often its documents may be repeated. Within a
source every document expects a number of copies in proportion to its weight. The whole part of it is certain; the
fraction is the probability of one copy more. Documents are ranked by their random odds divided by the odds of that
probability, and the first of them are taken as long as the words the source still lacks suffice: a sample of fixed size,
in words, whatever the probabilities are. What the next document is too long for goes to the first ones behind it that
are not.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import WORD, numbered, place_in_order, stage
from trendmill.operators.broadcasting import broadcast_if_small

# Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
# How often a document may be taken.
MAX_COPIES = 3
SEED = 42
# How often what is left of a source is offered to the documents behind the one that was too long for it.
REFILLS = 3
# Digits of a hash that make a random number: 52 bits, which a double holds exactly.
_DIGITS = 13


def word_count(text: Column) -> Column:
    """Words of a text; none for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD + "+")).cast("long")


def random_number(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number between 0 and 1, both excluded, that depends on the row alone, so a lost task draws it again."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    drawn = F.conv(F.substring(F.md5(said), 1, _DIGITS), 16, 10).cast("double")
    return (drawn + F.lit(0.5)) / F.lit(float(16 ** _DIGITS))


def _key(source: Column) -> Column:
    """One text per source that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), F.lit(">")).otherwise(F.concat(F.lit("="), source.cast("string")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(k, source_size, target) from (k, source_size): weighted shares of the whole, none above ``max_copies`` times its size.

    What a bounded source cannot take is shared among the others by weight, until no target is above its bound. The words
    a unit of weight gets only rise on the way, so a round needs two sums of all sources and the driver one number.
    """
    ranked = place_in_order(sizes.select(F.lit("").alias("k"), F.col("k").alias("source_key"), "source_size"), [F.col("source_key")])
    weighed = stage(ranked.select(
        F.col("source_key").alias("k"), "source_size", (F.col("source_size") * max_copies).alias("bound"),
        F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int")).alias("w")), "sources")
    total, share = weighed.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while total:
        full = F.col("bound") < F.lit(share) * F.col("w")
        held, open_weight = weighed.agg(
            F.sum(F.when(full, F.col("bound")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("w")))).first()
        if not open_weight or (total - held) / open_weight == share:
            break
        share = (total - held) / open_weight
    wanted = F.lit(share) * F.col("w")
    return weighed.select("k", "source_size", F.when(F.col("bound") < wanted, F.col("bound").cast("double")).otherwise(wanted).alias("target"))


def _copies_per_weight(rows: DataFrame, wanted: DataFrame, max_copies: int) -> DataFrame:
    """(k, c): with copies min(max_copies, c * weight) of each row, a source expects its target of words.

    Rows at their bound are set apart until no source has new ones. Sums are decimal, so they do not depend on the order
    in which tasks end.
    """
    c = wanted.select("k", F.lit(0.0).alias("c"))
    while True:
        joined = rows.join(broadcast_if_small(c), "k")
        full = F.col("c") * F.col("weight") >= max_copies
        sums = joined.groupBy("k").agg(
            F.sum(F.when(full, F.col("size") * max_copies).otherwise(0)).alias("held"),
            F.sum(F.when(full, 0).otherwise(F.col("size") * F.col("weight")).cast("decimal(38,9)")).cast("double").alias("open"))
        after = stage(wanted.join(sums, "k").join(c, "k").select(
            "k", F.col("c").alias("was"),
            F.when(F.col("open") > 0, F.greatest("c", (F.col("target") - F.col("held")) / F.col("open"))).otherwise(F.col("c")).alias("c")), "copies")
        c = after.select("k", "c")
        if after.filter("c > was").isEmpty():
            return c


def mix(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weight: str | None = None,
    weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED,
) -> DataFrame:
    """``docs`` without the text, with size (words), source_size, target (of the source, in words), copies and taken (words).

    The sum of all targets is the number of words there are. A source's taken words differ from its target by less than its
    longest document, and mostly by less than its shortest ones. ``weight`` names a column with a document's own weight in its source (null or negative: 0, never
    taken; a source of such documents takes nothing); without it all documents of a source are alike. Reruns give the
    same copies, as long as the rows are the same.

    Null text has no words and is taken as often as any, at no words. A null source is a source, the last one; a null doc_id
    is a name like others. Repeated rows draw the same number, and the order among them does not matter. Columns already
    named like a new one are replaced. An empty table gives no rows.
    """
    made = ("size", "source_size", "target", "copies", "taken")
    rest = [c for c in docs.columns if c != text and c not in made]
    item = "item"
    own = F.lit(1.0) if weight is None else F.greatest(F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)), F.lit(0.0))
    rows = stage(numbered(docs.select(
        _key(F.col(f"`{source}`")).alias("k"), word_count(F.col(f"`{text}`")).alias("size"),
        random_number(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), seed).alias("u"), own.alias("weight"),
        F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("tie"),
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias(item)), "row"), "sizes", "zstd")
    wanted = stage(targets(rows.groupBy("k").agg(F.sum("size").alias("source_size")), weights, max_copies), "targets")
    if weight is None:
        c = wanted.select("k", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("c"))
    else:
        c = _copies_per_weight(rows, wanted, max_copies)
    expected = F.least(F.col("c") * F.col("weight"), F.lit(float(max_copies)))
    split = rows.join(broadcast_if_small(wanted.join(c, "k")), "k").withColumn("whole", F.floor(expected)) \
        .withColumn("p", expected - F.col("whole"))
    certain = split.groupBy("k").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    lacking = stage(wanted.join(certain, "k").select("k", (F.col("target") - F.col("certain")).alias("lacking")), "lacking")
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    drawn = _sample(split.filter("p > 0 and size > 0").select("k", "row", "size", "tie", odds.alias("odds")), lacking)
    copies = F.col("whole") + F.col("more")
    return split.join(drawn.select("row", F.lit(1).cast("long").alias("more")), "row", "left").na.fill(0, ["more"]).select(
        *[F.col(f"{item}.`{name}`") for name in rest], "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))


def _sample(offered: DataFrame, lacking: DataFrame) -> DataFrame:
    """The rows that are taken once more: by their odds, while they fit into what their source is lacking.

    The last time half of a document has to fit, so that the source comes as near to its target from above or below.
    """
    taken = []
    for i in range(1 + REFILLS):
        half = 2 if i == REFILLS else 1
        fitting = offered.join(broadcast_if_small(lacking), "k").filter(F.col("size") <= half * F.col("lacking")).drop("lacking")
        ranked = place_in_order(fitting, [F.col("odds"), F.col("size"), F.col("tie")], weight="size")
        some = stage(ranked.join(broadcast_if_small(lacking), "k").filter(half * F.col("before") + F.col("size") <= half * F.col("lacking"))
                     .select("k", "row", "size"), "drawn")
        taken.append(some.select("row"))
        sums = some.groupBy("k").agg(F.sum("size").alias("got"))
        lacking = stage(lacking.join(sums, "k", "left").select(
            "k", (F.col("lacking") - F.coalesce("got", F.lit(0))).alias("lacking")), "lacking")
        offered = offered.join(some.select("row"), "row", "left_anti")
    return reduce(DataFrame.union, taken)


def repeated(mixed: DataFrame, into: str = "copy") -> DataFrame:
    """One row per copy that the mix takes, numbered from 0."""
    return mixed.filter("copies > 0").withColumn(into, F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))


def mix_sql(source: str) -> str:
    """DuckDB SQL for the query's rows."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    parts = ["""offered0 as (
        select doc_id, source, size, (u / (1 - u)) * ((1 - p) / p) as odds,
               target - (select sum(o.whole::bigint * o.size) from split o where o.source is not distinct from split.source) as lacking
        from split where p > 0 and size > 0)"""]
    for i in range(1 + REFILLS):
        half = 2 if i == REFILLS else 1
        parts.append(f"""drawn{i} as (
        select * from (select *, coalesce(sum(size) over (partition by source order by odds, size, doc_id
                           rows between unbounded preceding and 1 preceding), 0) as before from offered{i} where size <= {half} * lacking)
        where {half} * before + size <= {half} * lacking)""")
        parts.append(f"""offered{i + 1} as (
        select o.* replace (lacking - coalesce((select sum(d.size) from drawn{i} d where d.source is not distinct from o.source), 0) as lacking)
        from offered{i} o where doc_id not in (select doc_id from drawn{i}))""")
    parts.append("taken as (" + " union all ".join(f"select doc_id from drawn{i}" for i in range(1 + REFILLS)) + ")")
    rounds = ", ".join(parts)
    return f"""
    with base as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}+')) as size,
               (list_reduce(list_prepend(0::bigint, list_transform(string_split(substr(md5('{SEED}:' || coalesce(doc_id::varchar, '')
                   || ':' || coalesce(text, '')), 1, {_DIGITS}), ''), lambda c: (strpos('0123456789abcdef', c) - 1)::bigint)),
                   lambda a, b: a * 16 + b)::double + 0.5) / {float(16 ** _DIGITS)!r}::double as u
        from {source}
    ), sources as (
        select *, {MAX_COPIES} * source_size as bound, {weights}[(row_number() over (order by source nulls last) - 1) % {len(WEIGHTS)} + 1] as w
        from (select source, sum(size)::bigint as source_size from base group by source)
    ), filled as (
        select *, (sum(source_size) over () - sum(bound) over by_need)::double / nullif(sum(w) over () - sum(w) over by_need, 0) as share,
               lead(bound::double / w) over (order by bound::double / w, source) as next
        from sources window by_need as (order by bound::double / w, source rows between unbounded preceding and current row)
    ), first_share as (
        select coalesce(sum(source_size), 0)::double / sum(w) as share, min(bound::double / w) as next from sources
    ), lam as (
        select case when (select next >= share from first_share) then (select share from first_share)
                    else (select share from filled where next >= share order by bound::double / w, source limit 1) end as share
    ), wanted as (
        select source, source_size, case when bound < share * w then bound::double else share * w end as target from sources, lam
    ), split as (
        select *, floor(e) as whole, e - floor(e) as p from (
            select b.*, source_size, target, case when source_size > 0 then target / source_size else 0.0 end as e
            from base b join wanted t on b.source is not distinct from t.source)
    ), {rounds}
    select s.doc_id, size, source_size, target, ((whole::bigint + (t.doc_id is not null)::bigint) * size)::bigint as taken
    from split s left join taken t on s.doc_id = t.doc_id"""
