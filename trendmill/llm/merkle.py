"""Merkle manifest of a dataset: a root over all rows, and for every row the proof that it belongs to it.

Rows are leaves of a tree per group; the groups' roots are leaves of one more tree. Leaves are numbered in their group,
and every 256 consecutive ones form a block. A block keeps a level as one string of fixed-width digests: the parents are
the digests of its 16-digest substrings, and the siblings of a node are what flanks its own digest in such a substring.
Roots of blocks are numbered by their blocks, so the same step applies to them, until one is left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import place_in_order, stage

FANOUT = 16
# Leaves of a block: two levels of the tree.
BLOCK = FANOUT * FANOUT
# A digest is kept as hexadecimal text.
WIDTH = 64
_RUN = FANOUT * WIDTH
_MADE = ("leaf", "subroot", "root", "proof")


def encoded(value: Column) -> Column:
    """A value so that different rows never encode alike: "-" for null, else the length in bytes, ":" and the text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(values: Sequence[Column]) -> Column:
    """The leaf of a row: SHA-256 of its encoded values, as 64 hexadecimal digits."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof lead to."""
    return F.aggregate(proof, leaf, lambda own, s: F.sha2(F.concat(s["left"], own, s["right"]), 256))


def sibling_text(proof: Column) -> Column:
    """All siblings of a proof in one text, level by level from the leaf up, from left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / _RUN).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * _RUN + 1, F.lit(_RUN)), 256)), "") \
        .cast("binary")


def _blocks(nodes: DataFrame, *items: str) -> DataFrame:
    """The blocks of nodes (k, rank, total, h: 32 bytes), staged: their levels as strings, their root and the ``items``.

    A level is there if its group has more than one node on the level below. Levels are kept as bytes, of which a
    substring is cut in constant time.
    """
    sorted_nodes = F.array_sort(F.collect_list(F.struct("rank", "h", *[i for i in items if i != "h"])))
    blocks = nodes.groupBy("k", F.floor(F.col("rank") / BLOCK).alias("block"), "total").agg(sorted_nodes.alias("nodes"))
    text = F.array_join(F.transform("nodes", lambda x: F.lower(F.hex(x["h"]))), "").cast("binary")
    leveled = blocks.withColumn("l0", text)
    for below, level, least in (("l0", "l1", 1), ("l1", "l2", FANOUT)):
        leveled = leveled.withColumn(level, F.when(F.col("total") > least, _parents(F.col(below))))
    return stage(leveled.select(
        "k", "block", "total", *([F.transform("nodes", lambda x: F.struct(*[x[i].alias(i) for i in items])).alias("items")] if items else []),
        "l0", "l1", "l2", F.coalesce("l2", "l1", "l0").cast("string").alias("top")), "blocks", "zstd")


def _rounds(nodes: DataFrame, *items: str) -> list[DataFrame]:
    """Blocks of leaves, then of the roots of blocks, until every key has one block."""
    rounds = [_blocks(nodes, *items)]
    while not rounds[-1].filter(F.col("total") > BLOCK).isEmpty():
        rounds.append(_blocks(rounds[-1].select(
            "k", F.col("block").alias("rank"), F.ceil(F.col("total") / BLOCK).alias("total"), F.unhex("top").alias("h"))))
    return rounds


def _segments(i: Column) -> Column:
    """The siblings of the block's ``i``-th node, one pair of texts per level that the block has."""
    def flanks(level: str, at: Column) -> Column:
        run, inside = F.floor(at / FANOUT).cast("int"), (at % FANOUT).cast("int")
        return F.struct(
            F.substring(F.col(level), run * _RUN + 1, inside * WIDTH).cast("string").alias("left"),
            F.substring(F.col(level), (at + 1).cast("int") * WIDTH + 1, (FANOUT - 1 - inside) * WIDTH).cast("string").alias("right"))

    first, second = flanks("l0", i), flanks("l1", F.floor(i / FANOUT).cast("int"))
    none = F.array().cast("array<struct<left: string, right: string>>")
    return F.when(F.col("total") > FANOUT, F.array(first, second)).when(F.col("total") > 1, F.array(first)).otherwise(none)


def _paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(k, block, path, subroot) for every block of the first round; ``above`` has (k, path, subroot) per key."""
    paths = above.withColumn("block", F.lit(0).cast("bigint"))
    for blocks in reversed(rounds[1:]):
        places = F.sequence(F.lit(0), F.floor(F.octet_length("l0") / WIDTH).cast("int") - 1)
        below = F.transform(places, lambda i: F.struct(
            (F.col("block") * BLOCK + i).alias("block"), F.concat(_segments(i), F.col("path")).alias("path")))
        paths = blocks.join(paths, ["k", "block"]).select("k", "subroot", F.inline(below))
    return paths


def prove(leaves: DataFrame, group: str, order: str, leaf: str = "leaf") -> DataFrame:
    """``leaves`` with the columns leaf, subroot, root and proof; columns of these names are replaced.

    ``leaf`` names the digest column. Leaves of a group ascend by ``order`` (null first; equal ones by digest, so repeated
    rows stand side by side). While a group has several nodes, every 16 consecutive ones become their digest; what remains
    is its subroot, that of a single leaf the leaf itself. Subroots, by the bytes of the group's name, null first, give the
    root in the same way. ``proof`` is an array with one entry per level: the siblings left and right of the path, as
    text; ``fold`` leads from the leaf over it to the root. An empty table gives no rows.

    Shuffled are digests and the columns of ``leaves``, so those should be small; texts belong in the digest. One
    group, or one group per row, makes no difference to the tasks: blocks have 256 nodes. To the driver comes the root.
    """
    spark = leaves.sparkSession
    rest = [c for c in leaves.columns if c not in (leaf, *_MADE)]
    name = F.col(f"`{group}`").cast("string")
    # One text per group that is never null and sorts as the groups do.
    key = F.when(name.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), name))
    rows = leaves.select(key.alias("k"), F.unhex(F.col(f"`{leaf}`")).alias("h"),
                         F.struct(*[F.col(f"`{c}`") for c in rest]).alias("item"))
    rounds = _rounds(place_in_order(rows, [F.col(f"item.`{order}`").asc_nulls_first(), F.col("h")]), "h", "item")

    groups = rounds[-1].select(F.lit("").alias("k"), F.col("k").alias("group_key"), F.unhex("top").alias("h"))
    over = _rounds(place_in_order(groups, [F.col("group_key")]), "h", "group_key")
    last = over[-1].select("top").first()
    root = None if last is None else last[0]
    none = F.array().cast("array<struct<left: string, right: string>>")
    start = spark.range(1).select(F.lit("").alias("k"), none.alias("path"), F.lit(root).cast("string").alias("subroot"))
    per_group = _open(over[0], _paths(over, start)).select(
        F.col("group_key").alias("k"), F.col("proof").alias("path"), F.col("leaf").alias("subroot"))
    opened = _open(rounds[0], _paths(rounds, per_group))
    return opened.select(*[F.col(f"item.`{c}`") for c in rest], "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof")


def _open(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """The leaves of the first round with their items, their digest as text and their proof."""
    names = [f.name for f in blocks.schema["items"].dataType.elementType.fields if f.name != "h"]
    leaf = F.transform("items", lambda x, i: F.struct(
        *[x[n].alias(n) for n in names], F.lower(F.hex(x["h"])).alias("leaf"), F.concat(_segments(i), F.col("path")).alias("proof")))
    return blocks.join(paths, ["k", "block"]).select("subroot", F.inline(leaf))


def manifest_sql(source: str, depth: int = 6) -> str:
    """DuckDB SQL for the query's rows; ``depth`` levels suffice for 16**depth leaves of a group and as many groups."""
    def enc(column: str) -> str:
        return f"case when {column} is null then '-' else strlen({column}::varchar) || ':' || {column}::varchar end"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''),
             lambda c: ascii(c)::bigint)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

    def tree(name: str, start: str) -> list[str]:
        parts = [f"{name}0 as ({start})"]
        for d in range(depth):
            parts.append(f"""{name}{d + 1} as (
                select g, i // 16 as i, (n + 15) // 16 as n,
                       case when n > 1 then sha256(string_agg(h, '' order by i)) else min(h) end as h
                from {name}{d} group by g, i // 16, n)""")
        for d in range(depth):
            parts.append(f"""{name}s{d} as (
                select g, i, case when n > 1 then substr(run, 1, (i % 16) * 64) else '' end as l,
                       case when n > 1 then substr(run, (i % 16) * 64 + 65) else '' end as r, n > 1 as there
                from (select *, string_agg(h, '' order by i) over (
                          partition by g, i // 16 order by i rows between unbounded preceding and unbounded following) as run
                      from {name}{d}))""")
        return parts

    steps, before = [], "base"
    for name in ("t", "u"):
        for d in range(depth):
            group, at = ("b.g", "b.i") if name == "t" else ("''", "b.gi")
            steps.append(f"""{name}f{d} as (
                select b.* replace (case when x.there then sha256(x.l || b.own || x.r) else b.own end as own,
                                    b.siblings || x.l || x.r as siblings)
                from {before} b join {name}s{d} x on x.g = {group} and x.i = {at} // {16 ** d})""")
            before = f"{name}f{d}"
    leaves = f"""leaves as (
        select doc_id, case when source is null then '' else '=' || source end as g, {leaf('text')} as h,
               {leaf(f"translate(text, '{upper}', '{lower}')")} as changed, {crc} % 5 = 0 as tampered from {source})"""
    placed = """placed as (
        select *, row_number() over (partition by g order by doc_id) - 1 as i, count(*) over (partition by g) as n from leaves)"""
    ctes = [
        leaves, placed, *tree("t", "select g, i, n, h from placed"),
        f"subs as (select g, h as subroot, row_number() over (order by g) - 1 as gi, count(*) over () as gn from t{depth})",
        *tree("u", "select '' as g, gi as i, gn as n, subroot as h from subs"),
        """base as (select p.doc_id, p.g, p.i, s.gi, s.subroot, p.h as leaf,
                           case when p.tampered then p.changed else p.h end as own, '' as siblings
                    from placed p join subs s on p.g = s.g)""",
        *steps,
    ]
    return f"""with {', '.join(ctes)}
        select doc_id, leaf, subroot, (select h from u{depth}) as root, sha256(siblings) as proof_sha256,
               own as folded_root, own = (select h from u{depth}) as verified from {before}"""
