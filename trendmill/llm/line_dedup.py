"""Substring de-duplication: paragraphs of whole sentences or lines that repeat anywhere in the corpus are cut out.

A text is split into sentences, and once more into lines. From each of them on, as many as hold twenty words form a
paragraph; its digest stands for it. Digests are grouped globally, the earliest ranked occurrence of a digest stays, and
runs of repeated paragraphs that are long enough are removed from all other places.

On request a second search takes passages that begin and end inside sentences: windows of fifty words. Of all windows those
are compared whose smallest shingle of words occurs twice; equal windows have equal shingles, so none is missed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.llm.common import free_names, numbered, stage

# Words of a paragraph that is compared. Shorter ones are headings, signs and phrases; they repeat without being copies.
PARAGRAPH_WORDS = 20
# Words that have to repeat in a row. A passage of fifty words keeps its first sentence where the text before it has no
# end, so fewer are asked for.
RUN_WORDS = 30
# Words of the windows that are compared wherever they begin, and of the shingles of which the smallest stands for a window.
WINDOW_WORDS = 50
SHINGLE_WORDS = 25
# Digests a task sorts at once.
MAX_DIGESTS = 1 << 20
# Words a worker remembers the hash of.
MAX_HASHES = 1 << 17

# What ends a sentence; line breaks do not, so a text that is wrapped anew has the same sentences.
_ENDS = ".!?。！？"
_SPLIT = (re.compile(rf"[^{_ENDS}]+[{_ENDS}]*"), re.compile(r"[^\n]+"))
_NO_WORD = regex.compile(r"[^\p{L}\p{N}]+")
# Scripts that are written without spaces: two of their letters count as a word.
_UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-鿿"
_UNSPACED_LETTER = re.compile(f"[{_UNSPACED}]")
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}]+")
_WEIGHTS = np.random.default_rng(8).integers(0, 1 << 64, SHINGLE_WORDS, np.uint64) | np.uint64(1)


def units(text: str, kind: int) -> list[tuple[int, int, str, int]]:
    """(start, end, form, words) of the sentences (kind 0) or lines (kind 1) of a text that have a letter or digit.

    Offsets are in code points, without white space around the unit; form is lower case, words apart by single spaces.
    """
    found = []
    for match in _SPLIT[kind].finditer(text):
        raw = match.group()
        form = _NO_WORD.sub(" ", raw.lower()).strip()
        if form:
            start = match.start() + len(raw) - len(raw.lstrip())
            words = form.count(" ") + 1
            if not form.isascii():
                words += len(_UNSPACED_LETTER.findall(form)) // 2
            found.append((start, match.start() + len(raw.rstrip()), form, words))
    return found


def paragraphs(parts: list[tuple[int, int, str, int]], least: int = PARAGRAPH_WORDS) -> list[tuple[int, int]]:
    """(first, last) unit of every paragraph: from each unit on, the fewest that hold ``least`` words."""
    spans, end, words = [], 0, 0
    for first in range(len(parts)):
        while end < len(parts) and words < least:
            words += parts[end][3]
            end += 1
        if words < least:
            break
        spans.append((first, end - 1))
        words -= parts[first][3]
    return spans


def paragraph_digests(text: str | None) -> tuple[bytes, list[int]]:
    """(digests of 16 bytes, their places) of the paragraphs of a text; a place is twice the first unit plus the kind."""
    digests, places = [], []
    for kind in (0, 1) if text else ():
        parts = units(text, kind)
        forms = [p[2] for p in parts]
        for first, last in paragraphs(parts):
            digests.append(xxhash.xxh3_128_digest(" ".join(forms[first:last + 1]).encode("utf-8", "surrogatepass"), seed=kind))
            places.append(2 * first + kind)
    return b"".join(digests), places


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_HASHES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def stand_ins(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, for every window of WINDOW_WORDS the place of its smallest shingle); equal windows, equal hashes."""
    if len(words) < WINDOW_WORDS:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    shingles = np.convolve(np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words)), _WEIGHTS, "valid")
    shingles ^= shingles >> np.uint64(32)
    smallest = np.lib.stride_tricks.sliding_window_view(shingles, WINDOW_WORDS - SHINGLE_WORDS + 1).argmin(axis=1)
    return shingles, np.arange(len(smallest)) + smallest


def window_digests(text: str, marks: list[int]) -> tuple[bytes, list[int]]:
    """(digests of 16 bytes, first words) of the windows of a text whose smallest shingle is among ``marks``."""
    words = _WORD.findall(text)
    forms = [w.lower().encode("utf-8", "surrogatepass") for w in words]
    joined = b" ".join(forms)
    begins = np.cumsum([0, *(len(f) + 1 for f in forms)]).tolist()
    places = np.flatnonzero(np.isin(stand_ins(words)[1], marks)).tolist()
    return b"".join(xxhash.xxh3_128_digest(joined[begins[i]:begins[i + WINDOW_WORDS] - 1], seed=2) for i in places), places


def later_occurrences(source: DataFrame, digests: Callable[..., tuple[bytes, list[int]]], apart: int, label: str) -> DataFrame:
    """(row, places) of rows with digests that have an earlier occurrence; ``digests`` takes the columns behind row and doc_id.

    The earliest occurrence is that in the smallest doc_id (null last), then in the smallest row, then the first in the
    text. In its own text, repeats are only places that lie at least ``apart`` behind it. A task first looks for repeats
    among the texts of a batch: of a passage that a third of all documents share it passes on one place per batch, all
    others are repeats whatever the rest of the corpus holds. What is left is dealt out by digest, sorted, and read as a
    stream in which every row that has the digest of the row before it is a repeat.
    """
    def batch_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            order = sorted(range(len(rows)), key=lambda i: (names[i] is None, 0 if names[i] is None else names[i], rows[i]))
            found, at, place = [], [], []
            for i in order:
                some, places = digests(*(column[i].as_py() for column in batch.columns[2:]))
                found.append(some)
                at += [i] * len(places)
                place += places
                if len(at) >= MAX_DIGESTS or i == order[-1]:
                    yield of_batch(batch, rows, b"".join(found), np.array(at, np.int64), np.array(place, np.int64))
                    found, at, place = [], [], []

    def of_batch(batch: pa.RecordBatch, rows: list[int], found: bytes, at: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        both = np.frombuffer(found, ">u8").reshape(-1, 2)
        high, low = both[:, 0].astype("<u8").view(np.int64), (both[:, 1] >> 32).astype(np.uint32).view(np.int32)
        # Places came in the order of rank, and the sort keeps it among equal digests.
        turn = np.lexsort((low, high))
        high, low, place, row = high[turn], low[turn], place[turn], np.array(rows, np.int64)[at[turn]]
        first = first_of_equal(high, low)
        repeat = (first < np.arange(len(first))) & ((row != row[first]) | (place >= place[first] + apart))
        return pa.RecordBatch.from_arrays(
            [pa.array(row), batch.column(1).take(pa.array(at[turn])), pa.array(place), pa.array(high), pa.array(low), pa.array(repeat)],
            ["row", "doc_id", "place", "high", "low", "repeat"])

    def first_of_equal(high: np.ndarray, low: np.ndarray) -> np.ndarray:
        new = np.ones(len(high), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))

    def stream_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            if not batch.num_rows:
                continue
            # In front comes the first row of the digest the last batch ended with.
            high, low, row, place = (np.concatenate([b, c.to_numpy()]) for b, c in zip(before, batch.columns))
            first = first_of_equal(high, low)
            repeat = (first < np.arange(len(first))) & ((row != row[first]) | (place >= place[first] + apart))
            before = [c[first[-1]:first[-1] + 1] for c in (high, low, row, place)]
            yield pa.RecordBatch.from_arrays([pa.array(row[repeat]), pa.array(place[repeat])], ["row", "place"])

    kind = source.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", kind), T.StructField("place", T.LongType()),
                           T.StructField("high", T.LongType()), T.StructField("low", T.IntegerType()), T.StructField("repeat", T.BooleanType())])
    found = stage(source.mapInArrow(batch_repeats, schema), label, "zstd")
    dealt = found.filter("not repeat").repartition("high", "low").sortWithinPartitions(
        "high", "low", F.col("doc_id").asc_nulls_last(), "row", "place")
    across = dealt.select("high", "low", "row", "place").mapInArrow(stream_repeats, "row long, place long")
    return across.union(found.filter("repeat").select("row", "place")).groupBy("row").agg(F.collect_list("place").alias("places"))


def shared_shingles(texts: DataFrame) -> DataFrame:
    """(row, marks) of rows with shingles that stand for a window and occur twice or more; marks are their first words.

    Of the windows whose shingle is not among them none occurs twice. A task brings all places of a shingle in a batch as
    one row, so that of a shingle that a third of all documents share there is one row per batch.
    """
    def batch_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows, places = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles, stands = stand_ins(_WORD.findall(text.as_py() or ""))
                if len(stands):
                    places.append(np.unique(stands))
                    found.append(shingles[places[-1]].view(np.int64))
                    rows.append(np.full(len(places[-1]), row, np.int64))
            if found:
                shingle = np.concatenate(found)
                turn = np.argsort(shingle, kind="stable")
                shingle = shingle[turn]
                begins = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
                spots = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(rows)[turn]), pa.array(np.concatenate(places)[turn])], ["row", "place"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle[begins]), pa.ListArray.from_arrays(pa.array([*begins, len(shingle)], pa.int32()), spots)],
                    ["shingle", "spots"])

    spots = texts.select("row", "text").mapInArrow(batch_shingles, "shingle long, spots array<struct<row: long, place: long>>")
    n = F.sum(F.size("spots")).over(Window.partitionBy("shingle"))
    shared = spots.withColumn("n", n).filter("n > 1").select(F.inline("spots"))
    return shared.groupBy("row").agg(F.collect_list("place").alias("marks"))


def cut_runs(text: str, places: list[int], windows: list[int] = ()) -> tuple[str, list[tuple[int, int]]]:
    """(text without the runs of repeated paragraphs and windows, removed spans in offsets of the original text)."""
    spans = []
    for kind in (0, 1):
        firsts = {p >> 1 for p in places if p & 1 == kind}
        if not firsts:
            continue
        parts = units(text, kind)
        covered = np.zeros(len(parts), bool)
        for first, last in paragraphs(parts):
            if first in firsts:
                covered[first:last + 1] = True
        spans += runs([(start, end, words) for start, end, _, words in parts], covered, RUN_WORDS)
    spans = merged(spans)
    if windows:
        spans = merged(spans + window_runs(text, windows, spans))
    at, kept = 0, []
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join(kept) + text[at:], spans


def runs(parts: list[tuple[int, int, float]], covered: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the runs of covered (start, end, words) that hold ``least`` words."""
    found, i = [], 0
    while i < len(parts):
        j = i
        while j < len(parts) and covered[j]:
            j += 1
        if j > i and sum(p[2] for p in parts[i:j]) >= least:
            found.append((parts[i][0], parts[j - 1][1]))
        i = max(j, i + 1)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def window_runs(text: str, windows: list[int], gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words that lie in a repeated window between the spans that are gone already, and hold WINDOW_WORDS words."""
    words = [(m.start(), m.end(), 0.5 if _UNSPACED_LETTER.match(m.group()) else 1) for m in _WORD.finditer(text)]
    # A word is lost if the last span that begins before the word's end reaches over its beginning.
    begins, ends = np.array([w[0] for w in words]), np.array([w[1] for w in words])
    reach = np.array([-1, *(end for _, end in gone)])[np.searchsorted([start for start, _ in gone], ends, "left")]
    lost = np.cumsum([0, *(reach > begins)])
    turns = np.zeros(len(words) + 1, np.int64)
    for first in windows:
        if lost[first] == lost[first + WINDOW_WORDS]:
            turns[first] += 1
            turns[first + WINDOW_WORDS] -= 1
    return runs(words, np.cumsum(turns)[:-1] > 0, WINDOW_WORDS)


def remove_repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", into: str = "removed",
                             inside: bool = False) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and the column ``into`` with the spans that are gone.

    A passage is a run of whole sentences, or of whole lines, of which every part lies in a paragraph that occurs earlier in
    the corpus, and which has at least RUN_WORDS words. With ``inside``, so is a run of words between those passages of which
    every word lies in WINDOW_WORDS words in a row that occur earlier in the corpus, wherever its sentences begin and end;
    it has at least as many words, and two letters of a script without spaces count as one. A span has start and end, in code
    points of the original text, so every offset of the shorter text can be traced back; the text is what lies between the
    spans. Passages that repeat within one document are cut as well. The first occurrence of a paragraph or window is
    never cut on its account.

    Null text stays null, empty text empty, and a text of which everything is cut becomes empty or blank; no row is dropped.
    A repeated row loses its passages to the first of its copies. A null doc_id ranks last. Other columns pass through,
    whatever their names; a column already named ``into`` is replaced.
    """
    rest = [c for c in docs.columns if c.lower() != into.lower()]
    row, places, marks, windows = free_names([*rest, into], "row", "places", "marks", "windows")
    source = stage(numbered(docs.select(*[F.col(f"`{c}`") for c in rest]), row), "numbered", "zstd")
    texts = source.select(F.col(row).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = stage(later_occurrences(texts, paragraph_digests, 0, "paragraphs"), "repeats").select(
        F.col("row").alias(row), F.col("places").alias(places))
    # A merge join at every size: whether the places are small enough to broadcast would decide if texts are shuffled.
    joined = source.join(found.hint("merge"), row, "left")
    if inside:
        shared = stage(shared_shingles(texts), "shingles").select(F.col("row").alias(row), F.col("marks").alias(marks))
        # Only texts with a shared shingle are looked at again, and dealt out once more.
        whole = stage(joined.join(shared.hint("merge"), row, "left"), "marked", "zstd")
        some = whole.filter(F.col(marks).isNotNull())
        again = later_occurrences(
            some.select(F.col(row).alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(marks).alias("marks")),
            window_digests, WINDOW_WORDS, "windows")
        again = stage(again, "window-repeats").select(F.col("row").alias(row), F.col("places").alias(windows))
        others = whole.filter(F.col(marks).isNull()).withColumn(windows, F.lit(None).cast("array<long>"))
        joined = some.join(again.hint("merge"), row, "left").select(*[F.col(f"`{c}`") for c in others.columns]).union(others).drop(marks)
    else:
        joined = joined.withColumn(windows, F.lit(None).cast("array<long>"))
    joined = joined.select(*[F.col(f"`{c}`") for c in rest], places, windows)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*joined.schema.fields[:-2], T.StructField(into, T.ArrayType(span))])
    at = rest.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, spans = [], []
            for value, some, more in zip(batch.column(at), *batch.columns[-2:]):
                if some.is_valid or more.is_valid:
                    kept, removed = cut_runs(value.as_py(), some.as_py() or [], more.as_py() or [])
                else:
                    kept, removed = value.as_py(), []
                texts.append(kept)
                spans.append([{"start": a, "end": b} for a, b in removed])
            columns = [batch.column(i) for i in range(len(rest))]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], [*rest, into])

    return joined.mapInArrow(cut, schema)


def removal_sql(source: str) -> str:
    """DuckDB SQL for doc_id, n_removed, removed_chars, spans and the digest of what stays (doc_id unique)."""
    return f"""
    with raw as (
        select doc_id, kind, x from (
            select doc_id, 0 as kind, unnest(regexp_extract_all(text, '[^{_ENDS}]+[{_ENDS}]*|[{_ENDS}]+')) as x from {source}
            union all
            select doc_id, 1, unnest(regexp_extract_all(text, '[^\\n]+|\\n+')) from {source})
    ), numbered as (
        select doc_id, kind, x, row_number() over () as n from raw
    ), placed as (
        select *, coalesce(sum(length(x)) over (partition by doc_id, kind order by n rows between unbounded preceding and 1 preceding), 0) as pos,
               trim(regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) as form from numbered
    ), unit as (
        select doc_id, kind, form, pos + length(x) - length(ltrim(x, {_BLANK_SQL})) as start, pos + length(rtrim(x, {_BLANK_SQL})) as stop,
               row_number() over (partition by doc_id, kind order by n) as i,
               length(form) - length(replace(form, ' ', '')) + 1
                   + length(regexp_replace(form, '[^{_UNSPACED}]', '', 'g')) // 2 as words
        from placed where form <> ''
    ), summed as (
        select *, sum(words) over (partition by doc_id, kind order by i) as upto from unit
    ), listed as (
        select doc_id, kind, list(form order by i) as forms from unit group by doc_id, kind
    ), paragraph as (
        select a.doc_id, a.kind, a.i, b.i as j, md5(array_to_string(forms[a.i:b.i], ' ')) as digest
        from summed a asof join summed b on a.doc_id = b.doc_id and a.kind = b.kind and a.upto - a.words + {PARAGRAPH_WORDS} <= b.upto
                      join listed l on a.doc_id = l.doc_id and a.kind = l.kind
    ), repeated as (
        select * from (select *, row_number() over (partition by kind, digest order by doc_id, i) as occurrence from paragraph)
        where occurrence > 1
    ), covered as (
        select distinct doc_id, kind, unnest(range(i, j + 1)) as i from repeated
    ), run as (
        select doc_id, min(start) as start, max(stop) as stop
        from (select u.*, c.i - row_number() over (partition by c.doc_id, c.kind order by c.i) as island
              from covered c join unit u on c.doc_id = u.doc_id and c.kind = u.kind and c.i = u.i)
        group by doc_id, kind, island having sum(words) >= {RUN_WORDS}
    ), span as (
        select doc_id, min(start) as start, max(stop) as stop
        from (select *, sum(fresh::int) over (partition by doc_id order by start, stop) as part
              from (select *, coalesce(start > max(stop) over (partition by doc_id order by start, stop
                                       rows between unbounded preceding and 1 preceding), true) as fresh from run))
        group by doc_id, part
    ), kept as (
        select doc_id, string_agg(substr(text, pos::bigint + 1, (start - pos)::bigint), '' order by start) as text
        from (select s.doc_id, d.text, s.start, coalesce(lag(s.stop) over (partition by s.doc_id order by s.start), 0) as pos
              from (select * from span union all
                    select doc_id, length(text), length(text) from {source} where doc_id in (select doc_id from span)) s
              join {source} d on s.doc_id = d.doc_id)
        group by doc_id
    )
    select d.doc_id, coalesce(n, 0)::bigint as n_removed, coalesce(chars, 0)::bigint as removed_chars, coalesce(spans, '') as spans,
           sha256(coalesce(k.text, d.text, '')) as text_sha256
    from {source} d left join kept k on d.doc_id = k.doc_id
         left join (select doc_id, count(*) as n, sum(stop - start) as chars,
                           string_agg(start::bigint || '-' || stop::bigint, ' ' order by start) as spans from span group by doc_id) s
              on d.doc_id = s.doc_id"""


# White space as Python strips it, as far as texts have it.
_BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160) || chr(8232) || chr(8233) || chr(12288)"
