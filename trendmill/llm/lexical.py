"""Ranked lexical search of many queries at once, with what queries share evaluated once.

A query's score of a document is a sum over its terms. Sets of terms that several queries have in common are mined from a
block of queries and become nodes of a graph: a node adds up two others, a query adds up the few nodes it is left with.
For a batch of documents the values of all nodes are computed once, from the terms up, as vectors over the documents;
every query that contains a node uses the same vector.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendmill.llm.common import numbered, place_in_order, stage

TOP = 20
# Text of the queries that are evaluated together; a longer query is a block of its own.
BLOCK_BYTES = 4_000_000
# Terms of a query that take part in mining, those that most queries have. Others are added up one by one.
MINED_TERMS = 64
# Values of all nodes for a batch of documents.
_VALUES_AT_ONCE = 2_000_000
_ROUNDS = 20

# Letters, digits and everything beyond ASCII are terms, A-Z in lower case; all other bytes separate.
_SEPARATED = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_SEPARATED).split()


@dataclass(frozen=True)
class Plan:
    """Queries of a block as a graph. Nodes below ``len(vocabulary)`` are terms, each later one adds up two earlier ones.

    ``levels`` holds (left, right) arrays: all nodes of a level, whose parts lie on earlier levels. Query ``i`` adds up the
    nodes ``parts[starts[i]:starts[i + 1]]``.
    """

    vocabulary: dict
    levels: list
    parts: np.ndarray
    starts: np.ndarray

    @property
    def nodes(self) -> int:
        return len(self.vocabulary) + sum(len(left) for left, _ in self.levels)

    @property
    def additions(self) -> int:
        """Vector additions for a batch of documents."""
        return self.nodes - len(self.vocabulary) + len(self.parts) - np.count_nonzero(np.diff(self.starts))


def plan(texts: list[str | None]) -> Plan:
    """The graph of some queries.

    Each round counts how many queries hold which two nodes, and takes the commonest pairs, each query giving a node to one
    pair; a pair in at least two queries becomes a node. Repeats of a term in a query are nodes of their own value but are
    mined as different ones, so that they are counted as often as they occur. Rounds end when no two queries share a pair.
    """
    vocabulary: dict[bytes, int] = {}
    queries = []
    for text in texts:
        counts: Counter = Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms(text))
        queries.append({(t, k) for t, n in counts.items() for k in range(n)})
    in_queries = Counter(element for query in queries for element in query)
    # Elements are (node, which repeat); made nodes have no repeats.
    mined = [set(heapq.nsmallest(MINED_TERMS, (e for e in q if in_queries[e] > 1), key=lambda e: (-in_queries[e], e))) for q in queries]
    rest = [q - m for q, m in zip(queries, mined)]
    levels, made = [], len(vocabulary)
    for _ in range(_ROUNDS):
        holders: dict[tuple, list[int]] = {}
        for i, query in enumerate(mined):
            ordered = sorted(query)
            for x in range(len(ordered)):
                for y in ordered[x + 1:]:
                    holders.setdefault((ordered[x], y), []).append(i)
        pairs = sorted(((-len(at), pair) for pair, at in holders.items() if len(at) > 1))
        free = [set(q) for q in mined]
        left, right = [], []
        for _, (a, b) in pairs:
            at = [i for i in holders[a, b] if a in free[i] and b in free[i]]
            if len(at) < 2:
                continue
            left.append(a[0])
            right.append(b[0])
            for i in at:
                free[i] -= {a, b}
                mined[i] -= {a, b}
                mined[i].add((made, 0))
            made += 1
        if not left:
            break
        levels.append((np.array(left, np.int64), np.array(right, np.int64)))
    parts = [sorted(node for node, _ in m | r) for m, r in zip(mined, rest)]
    starts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return Plan(vocabulary, levels, np.array([n for p in parts for n in p], np.int64), starts)


def count_terms(docs: DataFrame, vocabulary: dict, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n (terms with repeats) and the vocabulary's terms with their counts, of documents with a term; staged."""
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in batches:
            rows = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms(value.as_py())
                if found:
                    ids = np.fromiter((known(t, -1) for t in found), np.int32, len(found))
                    distinct, counts = np.unique(ids[ids >= 0], return_counts=True)
                    rows.append((name, len(found), distinct.astype("<i4").tobytes(), counts.astype("<i4").tobytes()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                ["doc_id", "n", "ids", "counts"])

    return stage(source.mapInArrow(count, "doc_id long, n long, ids binary, counts binary"), "term-counts", "zstd")


def document_frequencies(counted: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is: one array, summed per task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                df[np.frombuffer(ids.as_py(), "<i4")] += 1
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], ["term", "df"])

    sums = counted.select("ids").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = np.zeros(size, np.int64)
    for row in sums.collect():
        df[row["term"]] = row["df"]
    return df


def _values(batch: pa.RecordBatch, a: int, b: int, graph: Plan, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The value of every node for the documents ``a`` to ``b`` of a batch: a row per node, a column per document."""
    values = np.zeros((graph.nodes, b - a), np.int64)
    for column, (n, ids, counts) in enumerate(zip(
            batch.column(1)[a:b].to_pylist(), batch.column(2)[a:b].to_pylist(), batch.column(3)[a:b].to_pylist())):
        m = 100 - 25 + (25 * n * n_docs) // n_terms
        at, tf = np.frombuffer(ids, "<i4"), np.frombuffer(counts, "<i4").astype(np.int64)
        values[at, column] = weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
    at = len(graph.vocabulary)
    for left, right in graph.levels:
        values[at:at + len(left)] = values[left] + values[right]
        at += len(left)
    return values


def _best(scores: np.ndarray, names: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((names, -scores))[:top]
    return scores[order], names[order]


def top_documents(counted: DataFrame, graph: Plan, weights: np.ndarray, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(query, doc_id, score): the ``top`` best documents of every query per task; a task keeps no more than those."""
    starts, n_queries = graph.starts, len(graph.starts) - 1
    width = max(1, min(4096, _VALUES_AT_ONCE // max(1, graph.nodes)))
    unnamed = np.iinfo(np.int64).max

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n_queries
        for batch in batches:
            names = np.array([unnamed if x is None else x for x in batch.column(0).to_pylist()], np.int64)
            for a in range(0, batch.num_rows, width):
                b = min(a + width, batch.num_rows)
                values = _values(batch, a, b, graph, weights, n_docs, n_terms)
                for q in range(n_queries):
                    if starts[q] == starts[q + 1]:
                        continue
                    scores = values[graph.parts[starts[q]:starts[q + 1]]].sum(axis=0)
                    known, ids = best[q]
                    least = known[-1] if len(known) == top else 1
                    new = np.flatnonzero(scores >= max(least, 1))
                    if len(new):
                        best[q] = _best(np.concatenate((known, scores[new])), np.concatenate((ids, names[a:b][new])), top)
        rows = [(q, None if name == unnamed else int(name), int(s)) for q, (found, ids) in enumerate(best) for s, name in zip(found, ids)]
        columns = list(zip(*rows)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "doc_id", "score"])

    return counted.mapInArrow(score, "query long, doc_id long, score long")


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """The items as lists of (number, text), block by block; a number per row, in the order of the ids."""
    rows = items.select(F.lit("").alias("k"), F.col(f"`{item_id}`").alias("name"), F.col(f"`{text}`").alias("text"))
    sized = numbered(rows.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 100), "row")
    placed = stage(place_in_order(stage(sized, "items"), [F.col("name").asc_nulls_first(), F.col("row")], weight="size"), "items")
    placed = placed.withColumn("block", F.floor((F.col("before") + F.col("size")) / BLOCK_BYTES))
    for block in [r[0] for r in placed.select("block").distinct().orderBy("block").collect()]:
        yield [(r["rank"], r["name"], r["text"]) for r in placed.filter(F.col("block") == block).orderBy("rank").collect()]


def search(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of every item by score, equal ones by ascending doc_id.

    Terms, weights and scores are whole numbers as the query's contract defines them. The items are the queries, taken in
    blocks of bounded text; every block is held against all documents, of which one pass counts the block's terms and
    another one scores. A document takes part with its whole text. To the driver comes a block of items and a number per
    term of it; a task keeps ``top`` documents per item.

    Null text has no terms; documents and items without terms have no rows, nor have pairs that share no term of weight.
    Repeated documents are ranked one by one; equal ones have one doc_id and follow each other. Every row of items is an
    item, also if its item_id is null or not its own. doc_id has to be a number (anything else is an error); a null doc_id
    comes after all others of its score. Further columns are not read.
    """
    spark = docs.sparkSession
    results, size = [], None
    for block in _blocks(items, item_id, item_text):
        graph = plan([t for _, _, t in block])
        counted = count_terms(docs, graph.vocabulary, text, doc_id)
        if size is None:
            size = counted.agg(F.count("*"), F.sum("n")).first()
        weights = term_weights(document_frequencies(counted, len(graph.vocabulary)), size[0])
        found = top_documents(counted, graph, weights, size[0], size[1] or 1, top)
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, name) for i, (_, name, _) in enumerate(block)], _names(items, item_id))
        results.append(stage(ranked.join(names, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "found"))
    if not results:
        return spark.createDataFrame([], _names(items, item_id)).selectExpr(
            "item_id", "cast(0 as int) as rank", "cast(0 as long) as doc_id", "cast(0 as long) as score")
    while len(results) > 1:
        results = [a.union(b) for a, b in zip(results[::2], results[1::2])] + ([results[-1]] if len(results) % 2 else [])
    return results[0]


def _names(items: DataFrame, item_id: str):
    kind = next(f.dataType for f in items.schema.fields if f.name == item_id)
    return f"query long, item_id {kind.simpleString()}"


def search_sql(documents: str, items: str, top: int = TOP) -> str:
    """DuckDB SQL for the rows of ``search`` (item_id and doc_id unique)."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    with found as (
        select doc_id, regexp_extract_all({lowered}, '{term}') as t from {documents}
    ), asked as (
        select item_id, unnest(regexp_extract_all({lowered}, '{term}')) as term from {items}
    ), size as (
        select count(*)::bigint as docs, sum(len(t))::bigint as total from found where len(t) > 0
    ), counted as (
        select doc_id, term, count(*)::bigint as tf, any_value(n)::bigint as n
        from (select doc_id, len(t) as n, unnest(t) as term from found) where term in (select term from asked) group by doc_id, term
    ), weighed as (
        select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from counted, size group by term, docs
    ), worth as (
        select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total))) as value
        from counted join weighed using (term), size
    ), scored as (
        select item_id, doc_id, sum(value)::bigint as score from asked join worth using (term) group by item_id, doc_id
    )
    select item_id, rank, doc_id, score from (
        select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scored where score > 0)
    where rank <= {top}"""
