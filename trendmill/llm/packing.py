"""Packing documents into sequences: a grouping genetic algorithm on islands.

Documents longer than a sequence are cut; whole sequences among the pieces stand alone. The others are dealt out to
blocks of bounded size. Several islands breed packings of each block: a child takes whole well-filled bins from one
parent, loses the bins of the other that hold the same pieces, and best-fits what those bins leave over. After each
epoch an island's elite moves to the next one. Bins that a block could not fill well are opened, and their pieces
packed again in fewer blocks, until one block holds the rest.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import numbered, stage
from trendmill.llm.tokens import encoder

CAPACITY = 4096
BLOCK_PIECES = 8192
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 5
POPULATION = 4
# A bin emptier than this share is opened for the next level.
WELL_FILLED = 0.995
_STATES_PER_TASK = 8

_STATE = "block long, island int, kind int, items binary, lengths binary, packings binary"


def pieces(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY, text: str = "text",
           doc_id: str = "doc_id") -> DataFrame:
    """The documents as token pieces, staged: item (a unique number), doc_id, piece, start, length, ids_crc32, ids.

    ids are in the encoder's width; ids_crc32 is the checksum of the ids as little-endian 32-bit numbers.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        last = np.array([end], words.dtype)
        for batch in batches:
            rows = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            texts = (x.as_py() for x in batch.column(1))
            for name, ids in zip(batch.column(0).to_pylist(), words.encode_all(texts)):
                ids = np.append(ids, last)
                for start in range(0, len(ids), capacity):
                    some = ids[start:start + capacity]
                    for column, value in zip(rows.values(), (
                            name, start // capacity, start, len(some), zlib.crc32(some.astype("<u4").tobytes()),
                            some.tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(rows.values(), (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], list(rows))

    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("t"))
    cut_up = source.mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")
    return stage(numbered(cut_up, "item"), "pieces", "zstd")


# --- one block -------------------------------------------------------------------------------------------------------

def best_fit(lengths: list[int], order: list[int], bins: np.ndarray, room: list[int], capacity: int) -> list[int]:
    """Put the pieces of ``order`` one by one into the fullest bin that has room. Changes ``bins``; returns the rooms."""
    open_bins = sorted((r << 32) | b for b, r in enumerate(room) if r > 0)
    for i in order:
        need = lengths[i]
        at = bisect_left(open_bins, need << 32)
        if at == len(open_bins):
            b, left = len(room), capacity - need
            room.append(left)
        else:
            key = open_bins.pop(at)
            b, left = key & 0xFFFFFFFF, (key >> 32) - need
            room[b] = left
        bins[i] = b
        if left:
            insort(open_bins, (left << 32) | b)
    return room


def _fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among equals, fuller ones beside emptier ones."""
    fill = np.bincount(bins, lengths)
    return -len(fill), float(((fill / capacity) ** 2).sum())


def _by_size(lengths: np.ndarray, noise: np.ndarray | None = None) -> list[int]:
    return np.argsort(-(lengths if noise is None else lengths * noise), kind="stable").tolist()


def cross(ours: np.ndarray, theirs: np.ndarray, lengths: np.ndarray, listed: list[int], capacity: int,
          random: np.random.Generator) -> np.ndarray:
    """A child of ``ours`` that has whole well-filled bins of ``theirs``."""
    fill = np.bincount(theirs, lengths)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = random.choice(good, max(1, min(len(good), len(fill) // 12)), replace=False)
    taken = np.isin(theirs, chosen)
    opened = np.zeros(int(ours.max()) + 1, bool)
    opened[ours[taken]] = True
    # The emptiest bins are opened too: that is how a bin can go.
    opened[np.argsort(np.bincount(ours, lengths), kind="stable")[:2]] = True
    kept = ~opened[ours] & ~taken
    child = np.full(len(ours), -1, np.int64)
    _, child[kept] = np.unique(ours[kept], return_inverse=True)
    n = int(child.max()) + 1
    _, inverse = np.unique(theirs[taken], return_inverse=True)
    child[taken] = inverse + n
    placed = child >= 0
    room = (capacity - np.bincount(child[placed], lengths[placed])).astype(np.int64).tolist()
    loose = np.flatnonzero(~placed)
    best_fit(listed, loose[np.argsort(-lengths[loose], kind="stable")].tolist(), child, room, capacity)
    return child


def evolve(lengths: np.ndarray, packings: list[np.ndarray], capacity: int, seed: list[int],
           generations: int = GENERATIONS, population: int = POPULATION) -> list[np.ndarray]:
    """The best packings after some generations, best first. Nothing is random but by ``seed``."""
    random = np.random.default_rng(seed)
    listed = lengths.tolist()
    while len(packings) < population:
        noise = None if not packings else random.uniform(0.8, 1.2, len(lengths))
        bins = np.zeros(len(lengths), np.int64)
        best_fit(listed, _by_size(lengths, noise), bins, [], capacity)
        packings = [*packings, bins]
    scored = sorted(((_fitness(b, lengths, capacity), -k, b) for k, b in enumerate(packings)), reverse=True,
                    key=lambda x: x[:2])[:population]
    least = -(-int(lengths.sum()) // capacity)
    for _ in range(generations):
        if -scored[0][0][0] <= least:
            break
        children = []
        for k in range(population):
            i, j = sorted(random.choice(len(scored), 2, replace=False).tolist())
            parents = (scored[i][2], scored[j][2]) if k % 2 else (scored[j][2], scored[i][2])
            child = cross(*parents, lengths, listed, capacity, random)
            children.append((_fitness(child, lengths, capacity), -k - population, child))
        scored = sorted(scored + children, reverse=True, key=lambda x: x[:2])[:population]
    return [b for _, _, b in scored]


# --- islands ---------------------------------------------------------------------------------------------------------

def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Neighbouring rows with equal first ``keys`` columns, across batches."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        begins = [0, *np.flatnonzero(changed).tolist()]
        for a, b in zip(begins, [*begins[1:], batch.num_rows]):
            key = tuple(int(c[a]) for c in columns)
            if key != now and held:
                yield now, held
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield now, held


def _state(block: int, island: int, kind: int, items: bytes, lengths: bytes, packings: list[np.ndarray]) -> tuple:
    return block, island, kind, items, lengths, b"".join(p.astype("<i4").tobytes() for p in packings)


def _states(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    names = [c.split()[0] for c in _STATE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _packings(data: bytes, n: int) -> list[np.ndarray]:
    return list(np.frombuffer(data, "<i4").reshape(-1, n).astype(np.int64))


def _pack_level(loose: DataFrame, blocks: int, level: int, capacity: int) -> DataFrame:
    """(item, length, sequence_id, offset, fill) of pieces (item, length) packed within ``blocks`` blocks."""
    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,), parts in _runs(batches, 1):
            items = np.concatenate([p.column(1).to_numpy() for p in parts])
            lengths = np.concatenate([p.column(2).to_numpy() for p in parts])
            yield _states([_state(block, i, 0, items.tobytes(), lengths.tobytes(), []) for i in range(ISLANDS)])

    def epoch(number: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (block, island), parts in _runs(batches, 2):
                rows = [r for p in parts for r in p.to_pylist()]
                own = next(r for r in rows if r["kind"] == 0)
                lengths = np.frombuffer(own["lengths"], np.int64)
                known = [b for r in rows for b in _packings(r["packings"], len(lengths))]
                best = evolve(lengths, known, capacity, [level, block, island, number])
                out = [_state(block, island, 0, own["items"], own["lengths"], best)]
                if ISLANDS > 1:
                    out.append(_state(block, (island + 1) % ISLANDS, 1, b"", b"", best[:1]))
                yield _states(out)
        return run

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _runs(batches, 1):
            best = None
            for row in (r for p in parts for r in p.to_pylist() if r["kind"] == 0):
                lengths = np.frombuffer(row["lengths"], np.int64)
                bins = _packings(row["packings"], len(lengths))[0]
                score = _fitness(bins, lengths, capacity)
                if best is None or score > best[0]:
                    best = score, np.frombuffer(row["items"], np.int64), lengths, bins
            _, items, lengths, bins = best
            order = np.lexsort((items, bins))
            items, lengths, bins = items[order], lengths[order], bins[order]
            first = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
            each = np.diff(np.append(first, len(bins)))
            before = np.cumsum(lengths) - lengths
            fill = np.add.reduceat(lengths, first)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (
                items, lengths, np.repeat(items[first], each), before - np.repeat(before[first], each),
                np.repeat(fill, each))], ["item", "length", "sequence_id", "offset", "fill"])

    tasks = -(-blocks * ISLANDS // _STATES_PER_TASK)
    block = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(blocks)).alias("block")
    dealt = loose.select(block, "item", "length").repartition(-(-blocks // _STATES_PER_TASK), "block") \
        .sortWithinPartitions("block", "item")
    states = dealt.mapInArrow(settle, _STATE)
    for number in range(EPOCHS):
        states = states.repartition(tasks, "block", "island").sortWithinPartitions("block", "island", "kind") \
            .mapInArrow(epoch(number), _STATE)
    return states.filter("kind = 0").repartition(tasks, "block").sortWithinPartitions("block", "island") \
        .mapInArrow(choose, "item long, length long, sequence_id long, offset long, fill long")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(item, sequence_id, offset) for pieces (item: unique long, length: 1 to ``capacity``).

    A sequence is named after its smallest item, pieces lie in it by item without gaps. Levels end with one block, or when
    opening bins again no longer halves the pieces. An empty table gives an empty one.
    """
    alone = items.filter(F.col("length") == capacity) \
        .select("item", F.col("item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    loose = items.filter(F.col("length") < capacity).select("item", F.col("length").cast("long").alias("length"))
    n, level, done = loose.count(), 0, alone
    while n:
        blocks = -(-n // BLOCK_PIECES)
        packed = stage(_pack_level(loose, blocks, level, capacity), "packed")
        final = packed
        if blocks > 1:
            well = F.col("fill") >= WELL_FILLED * capacity
            rest = packed.filter(~well).count()
            if 2 * rest <= n:
                final, loose = packed.filter(well), packed.filter(~well).select("item", "length")
                n, level = rest, level + 1
            else:
                n = 0
        else:
            n = 0
        done = done.union(final.select("item", "sequence_id", "offset"))
    return done


def pack_documents(docs: DataFrame, vocabulary: str, end: int, capacity: int = CAPACITY, text: str = "text",
                   doc_id: str = "doc_id") -> DataFrame:
    """The pieces of ``docs`` with their places: doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset.

    Null text counts as empty and gives a piece with the end id alone. Repeated rows and rows that share a doc_id are
    packed each for itself; a null doc_id is carried along. Texts are encoded whole, other columns are not read. Asking
    for no ids keeps them out of every shuffle.
    """
    cut = pieces(docs, vocabulary, end, capacity, text, doc_id)
    return cut.join(pack(cut, capacity), "item").drop("item")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids and doc_ids of the packed sequences; each has at most ``CAPACITY`` tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts")).select(
        "sequence_id", "n_tokens",
        F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
