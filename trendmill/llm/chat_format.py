"""Conversations as training texts, with the parts a model is to learn marked, and back again."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.llm.chat_template import compile_template, unescape

# Turns between control strings; inside roles and texts control strings are escaped.
TEMPLATE = """
{%- for message in messages -%}
    {{ "<|im_start|>" ~ message.role | escape_line ~ "\\n" }}
    {%- if message.role == "assistant" -%}
        {% generation %}{{ message.text | escape_control }}{% endgeneration %}
    {%- else -%}
        {{ message.text | escape_control }}
    {%- endif -%}
    {{ "<|im_end|>" ~ "\\n" }}
{%- endfor -%}
"""
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
# A conversation of more characters goes on in another row.
CHUNK_CHARS = 1 << 18
_MASK = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_conversations(rows: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, chunk, text and mask of every conversation, rendered by ``template`` with the list ``messages``.

    mask has the spans [start, end) of the chunk's text, in code points, that a model learns to write. A conversation of
    more than CHUNK_CHARS characters continues in further chunks, cut between two pieces of output. Turns go by turn
    (null first); rows that share a turn by role and text. Null text and null role are empty. Rows with a null conv_id are
    one conversation. Repeated rows are repeated turns. Other columns are not read.

    A conversation is rendered by one task in the order of its turns, but it is read and written as a stream: no task
    holds more than a chunk and a turn of it.
    """
    source = rows.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = compile_template(template)

        def turns():
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist())

        out, held = [], 0
        for name, group in groupby(turns(), key=lambda r: r[0]):
            chunk = 0
            for body, mask in _chunks(run(messages=({"role": r, "text": t} for _, r, t in group))):
                out.append((name, chunk, body, mask))
                chunk, held = chunk + 1, held + len(body)
                if held >= CHUNK_CHARS:
                    yield _rows(out)
                    out, held = [], 0
        if out:
            yield _rows(out)

    ordered = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(
        render, "conv_id long, chunk long, text string, mask array<struct<start: long, end: long>>")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names, chunks, texts, masks = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(chunks, pa.int64()), pa.array(texts, pa.string()), pa.array(masks, _MASK)],
        ["conv_id", "chunk", "text", "mask"])


def _chunks(pieces: Iterator[tuple[str, bool]]) -> Iterator[tuple[str, list[dict]]]:
    texts, mask, size = [], [], 0
    for text, learned in pieces:
        if learned:
            if mask and mask[-1]["end"] == size:
                mask[-1]["end"] += len(text)
            else:
                mask.append({"start": size, "end": size + len(text)})
        texts.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield "".join(texts), mask
            texts, mask, size = [], [], 0
    if texts:
        yield "".join(texts), mask


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rows of ``format_conversations`` say, by conversation; TEMPLATE's marks are expected.

    conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed per turn), loss_chars and loss_sha256 (of the
    text under the mask), formatted_chars. The chunks of a conversation must still lie together in order, as
    ``format_conversations`` leaves them; they are read one by one.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunks():
            for batch in batches:
                yield from batch.to_pylist()

        out = []
        for name, group in groupby(chunks(), key=lambda r: r["conv_id"]):
            turns, learned, rest = hashlib.sha256(), hashlib.sha256(), ""
            n_turns = loss = size = 0
            for chunk in group:
                size += len(chunk["text"])
                for span in chunk["mask"]:
                    text = unescape(chunk["text"][span["start"]:span["end"]])
                    loss += len(text)
                    learned.update(text.encode())
                rest += chunk["text"]
                at = 0
                for m in _TURN.finditer(rest):
                    if m.start() != at:
                        raise ValueError(f"conversation {name}: no turn at {rest[at:at + 20]!r}")
                    turns.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                    n_turns, at = n_turns + 1, m.end()
                rest = rest[at:]
            if rest:
                raise ValueError(f"conversation {name} ends within a turn")
            out.append((name, n_turns, turns.hexdigest(), loss, learned.hexdigest(), size))
            if len(out) >= 1000:
                yield _table(out)
                out = []
        if out:
            yield _table(out)

    return formatted.mapInArrow(read, _READ)


_READ = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[f.dataType]) for c, f in zip(zip(*rows), _READ)], [f.name for f in _READ])
