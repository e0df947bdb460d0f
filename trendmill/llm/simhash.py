"""SimHash near-duplicates: fingerprints of word shingles, linked when few bits differ.

Distinct fingerprints meet in buckets that share some of their bits. Inside a bucket they are compared bit-sliced: bit
p of 64 fingerprints lies in one machine word, and carry-save counters add up the differing bits of all of them at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import free_names, numbered, stage
from trendmill.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
# Two of five blocks of the fingerprint are equal if at most three bits differ: ten tables of 25-bit keys.
BLOCKS = 5
# Members of a bucket that one comparison holds; larger buckets are dealt out as pairs of parts.
PART = 4096
# Bucket members that one task takes.
_TASK_MEMBERS = 20_000
_ROWS_AT_ONCE = 256
_HASHES_AT_ONCE = 65_536


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hash of every run of ``shingle`` words; a shorter text is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' hashes. No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        some = [digest(joined[a:b], seed)
                for a, b in zip(starts[at:at + _HASHES_AT_ONCE].tolist(), ends[at:at + _HASHES_AT_ONCE].tolist())]
        counts += _bits(np.array(some, np.uint64)).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def _bits(values: np.ndarray) -> np.ndarray:
    """A row of 64 bits, lowest first, per value."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(len(values), 8), axis=1, bitorder="little")


def with_fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` without the text column, with the fingerprint as a long (the same 64 bits, signed)."""
    rest = [c for c in docs.columns if c != text]
    [t] = free_names(rest, "t")
    source = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(t))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(x.as_py()) for x in batch.column(len(rest))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values.view(np.int64))], [*rest, into])

    schema = source.select(*[F.col(f"`{c}`") for c in rest], F.lit(0).cast("long").alias(into)).schema
    return source.mapInArrow(prints, schema)


def planes_of(values: np.ndarray) -> np.ndarray:
    """Vertical layout: row p holds bit p of every value, 64 values to a word."""
    bits = np.zeros((64, -(-len(values) // 64) * 64), np.uint8)
    bits[:, :len(values)] = _bits(values).T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def within_radius(queries: np.ndarray, planes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Per query a row of words; a bit is set if that value of ``planes`` differs in at most ``radius`` bits.

    Counters of len(bin(radius)) bits start so that they overflow at the first bit too many. A full adder takes in two
    planes at a time. Every eight planes, queries whose whole row has overflowed are dropped.
    """
    digits = max(1, radius.bit_length())
    spare = (1 << digits) - 1 - radius
    alive = np.arange(len(queries))
    masks = np.where(_bits(queries) == 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    shape = (len(queries), planes.shape[1])
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    count = [np.full(shape, full if spare >> k & 1 else 0, np.uint64) for k in range(digits)]
    over = np.zeros(shape, np.uint64)
    for p in range(0, 64, 2):
        first = planes[p] ^ masks[:, p, None]
        second = planes[p + 1] ^ masks[:, p + 1, None]
        half = count[0] ^ first
        carry = (count[0] & first) | (half & second)
        count[0] = half ^ second
        for k in range(1, digits):
            carry, count[k] = count[k] & carry, count[k] ^ carry
        over |= carry
        if p % 8 == 6:
            open_rows = (over != full).any(axis=1)
            if not open_rows.all():
                alive, masks, over = alive[open_rows], masks[open_rows], over[open_rows]
                count = [c[open_rows] for c in count]
                if not len(alive):
                    break
    result = np.zeros(shape, np.uint64)
    result[alive] = ~over
    return result


def spanning_links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what all links between ``left`` and ``right`` (or within ``left``) connect.

    Every pair is compared; of the links found, those between values already connected are left out, so there are fewer
    links than values.
    """
    values = left if right is None else np.concatenate((left, right))
    shift = 0 if right is None else len(left)
    other = values[shift:]
    planes = planes_of(other)
    label = np.arange(len(values))
    links = []
    for at in range(0, len(left), _ROWS_AT_ONCE):
        near = within_radius(left[at:at + _ROWS_AT_ONCE], planes, radius)
        flags = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :len(other)]
        for i in np.flatnonzero(flags.any(axis=1)):
            found = np.flatnonzero(flags[i]) + shift
            labels, first = np.unique(label[found], return_index=True)
            mine = label[at + i]
            for one, k in zip(labels.tolist(), first.tolist()):
                if one != mine:
                    links.append((int(values[at + i]), int(values[found[k]])))
            joined = np.append(labels, mine)
            if len(labels) > 1 or labels[0] != mine:
                label[np.isin(label, joined)] = joined.min()
    return links


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a cell lie together, sorted by cell and side; cells may span batches."""
    def links(cell: tuple | None, sides: dict[int, list]) -> list[tuple[int, int]]:
        if cell is None:
            return []
        parts = [np.concatenate(sides[k]).view(np.uint64) for k in sorted(sides)]
        if cell[2] == cell[3]:
            return spanning_links(parts[0], None) if len(parts[0]) > 1 else []
        return spanning_links(parts[0], parts[1]) if len(parts) > 1 else []

    def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    cell, sides, found = None, {}, []
    for batch in batches:
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        prints = batch.column(5).to_numpy(zero_copy_only=False)
        changed = np.zeros(batch.num_rows, bool)
        for k in keys:
            changed[1:] |= k[1:] != k[:-1]
        begins = [0, *np.flatnonzero(changed).tolist()] if batch.num_rows else []
        for a, b in zip(begins, [*begins[1:], batch.num_rows]):
            here = tuple(int(k[a]) for k in keys)
            if here[:4] != cell:
                found += links(cell, sides)
                cell, sides = here[:4], {}
            sides.setdefault(here[4], []).append(prints[a:b])
        if len(found) > 10_000:
            yield out(found)
            found = []
    yield out(found + links(cell, sides))


def link(prints: DataFrame, part: int = PART) -> DataFrame:
    """Links (a, b) that connect all fingerprints of column ``fingerprint`` within RADIUS of each other.

    The work is on distinct fingerprints. A bucket of more than ``part`` of them is dealt out by hash into parts, and
    each pair of parts is a cell of its own, so no task holds more than two parts and none of the pairs is skipped.
    """
    nodes = prints.select("fingerprint").distinct()
    bounds = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    masks = [x | y for x, y in combinations(blocks, BLOCKS - RADIUS)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = stage(nodes.select("fingerprint", F.posexplode(F.array(*[
        F.col("fingerprint").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("t", "k")), "keyed")
    shared = stage(keyed.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    parts = F.ceil(F.col("n") / part).cast("int")
    # Fingerprints are small and comparing them is not, so tasks are counted by members, not by bytes.
    members = shared.agg(F.sum(F.col("n") * parts)).first()[0] or 0
    n_tasks = max(prints.sparkSession.sparkContext.defaultParallelism, -(-members // _TASK_MEMBERS))
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    cells = keyed.join(shared, ["t", "k"]).withColumn("parts", parts).withColumn("mine", mine) \
        .select("t", "k", "mine", "fingerprint", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")) \
        .select("t", "k", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                (F.col("mine") > F.col("other")).cast("int").alias("side"), "fingerprint")
    order = ["t", "k", "i", "j"]
    return cells.repartition(int(n_tasks), *order).sortWithinPartitions(*order, "side").mapInArrow(_compare, "a long, b long")


def classes(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(fingerprint, root, component_id) of every fingerprint.

    root is one fingerprint of the class, component_id the smallest doc_id that can be reached.
    """
    nodes = stage(prints.groupBy("fingerprint").agg(F.min(doc_id).alias("low")), "nodes")
    stars = stage(components(link(nodes)), "stars").select(F.col("node").alias("fingerprint"), "root")
    lows = nodes.join(stars, "fingerprint").groupBy("root").agg(F.min("low").alias("least"))
    linked = stars.join(lows, "root").select("fingerprint", "root", "least")
    return nodes.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"),
        F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("least")).alias("component_id"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``.

    Null text counts as empty; texts without words all have fingerprint zero and are linked like any others. Rows with a
    null doc_id are linked and returned too; they give a class its id only if no other row does (then it is null).
    Repeated rows are returned as often as they occur. Only the two named columns are read.
    """
    prints = stage(with_fingerprints(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))), "prints")
    return prints.join(classes(prints), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the smallest doc_id.

    Among rows of that doc_id one stays; a class in which every doc_id is null keeps one row as well.
    """
    row, print_ = free_names(docs.columns, "row", "fingerprint")
    source = stage(numbered(docs, row), "numbered", "zstd")
    prints = stage(with_fingerprints(source.select(
        F.col(row).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))), "prints")
    kept = prints.join(classes(prints), "fingerprint").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))["row"].alias(row))
    return source.join(kept.select(row), row, "left_semi").drop(row)
