"""Exact de-duplication as a stream with keyed state.

Arriving documents are put into a content store, and one small row each into a folder of arrivals. A streaming
aggregation over that folder keeps, per digest and for ever, the row to keep (its stable identifier), the place of its
content and the number of copies; the state lies on disk, in Spark's RocksDB state store. Copies are counted in the tasks
before they are shuffled, so a text that a third of all rows share is no burden. Whoever hits a known digest has its full
bytes compared with the content kept for it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendmill.llm.common import free_names, open_store, scratch_path, stage

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Otherwise each of the stores, one per shuffle partition, reserves megabytes of disk before it holds a row.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# What every arrival has; ``rest`` holds the other columns of its table.
_ARRIVAL = "doc_id long, sha256 string, digest string, file string, offset long, size long, was_null boolean"
# One row per table that was added: the names it had, and the columns in their order as a JSON schema.
_TABLES = "number long, text string, doc_id string, columns string"
_ORDER = ("doc_id", "file", "offset")
_CLASSES = "digest string, keeper struct<doc_id: bigint, file: string, offset: bigint, size: bigint>, n long"
# Checking a digest fetches contents in the order of the store; so many files stay open.
_OPEN_FILES = 8


class Deduplicator:
    """A corpus that documents are added to. ``folder`` is in the shared storage and may outlive the session.

    Tables may differ in columns: a survivor has those of all tables, null where its own had none. The name of the text, of
    the doc_id and the type of a column are the same in all of them; the folder remembers them.

    ``digest_chars`` shortens the hexadecimal key of the state, so that tests can make different texts collide.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, digest_chars: int = 64):
        self.spark = spark
        self.folder = folder or scratch_path(spark, "exact")
        self.digest_chars = digest_chars

    def _tables(self) -> list:
        """The tables that were added, in their order: names and types, no rows."""
        try:
            rows = self.spark.read.schema(_TABLES).parquet(f"{self.folder}/tables").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows, key=lambda r: r["number"])

    @staticmethod
    def _columns(tables: list) -> T.StructType:
        """The columns of all tables, in the order they came up."""
        fields: dict[str, T.StructField] = {}
        for added in tables:
            for field in T.StructType.fromJson(json.loads(added["columns"])):
                if fields.setdefault(field.name, field).dataType != field.dataType:
                    raise ValueError(f"{field.name} was {fields[field.name].dataType.simpleString()} in an earlier table")
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])

    def _remember(self, docs: DataFrame, text: str, doc_id: str) -> None:
        before = self._tables()
        if before and (before[0]["text"], before[0]["doc_id"]) != (text, doc_id):
            raise ValueError(f"the corpus has its texts in {before[0]['text']} and its ids in {before[0]['doc_id']}")
        row = (len(before), text, doc_id, docs.schema.json())
        new = self.spark.createDataFrame([row], _TABLES)
        self._columns([*before, new.first()])
        if row[1:] not in [tuple(r)[1:] for r in before]:
            new.coalesce(1).write.mode("append").parquet(f"{self.folder}/tables")

    # --- adding ------------------------------------------------------------------------------------------------------

    def add(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> None:
        """Store the texts and append the arrivals. Null text is stored as empty; ``rest`` keeps the other columns.

        The doc_id decides who stays, so it has to be an integer; anything else is a ValueError.

        A task writes its contents to a file of its own; only what a finished task returned is an arrival, so the file of
        a lost task is never read.
        """
        folder, key = self.folder, self.digest_chars
        names = docs.columns
        if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
            raise ValueError(f"{doc_id} is {docs.schema[doc_id].dataType.simpleString()}, not an integer")
        self._remember(docs, text, doc_id)
        source = docs.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"),
            F.struct(*[F.col(f"`{c}`") for c in names if c != text] or [F.lit(None).alias("none")]).alias("rest"))
        rest = source.schema["rest"].dataType

        def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = open_store(folder)
            store.create_dir(f"{root}/content", recursive=True)
            name, out, at = f"content/{uuid.uuid4().hex}", None, 0
            pack = zstandard.ZstdCompressor(level=1)
            for batch in batches:
                out = out or store.open_output_stream(f"{root}/{name}")
                digests, offsets, sizes = [], [], []
                for value in batch.column(1):
                    data = value.as_py() or b""
                    digests.append(hashlib.sha256(data).hexdigest())
                    packed = pack.compress(data)
                    out.write(packed)
                    offsets.append(at)
                    sizes.append(len(packed))
                    at += len(packed)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(digests), pa.array([d[:key] for d in digests]),
                    pa.array([name] * batch.num_rows, pa.string()), pa.array(offsets, pa.int64()),
                    pa.array(sizes, pa.int64()), batch.column(1).is_null(), batch.column(2),
                ], ["doc_id", "sha256", "digest", "file", "offset", "size", "was_null", "rest"])
            if out is not None:
                out.close()

        schema = T.StructType([*T.StructType.fromDDL(_ARRIVAL), T.StructField("rest", rest)])
        source.mapInArrow(save, schema).write.mode("append").parquet(f"{self.folder}/arrivals")

    # --- the stream --------------------------------------------------------------------------------------------------

    def update(self) -> None:
        """Run the stream over what arrived since the last time; the checkpoint in ``folder`` remembers how far it got."""
        spark, folder = self.spark, self.folder
        before = {key: spark.conf.get(key, None) for key in _STATE_CONF}
        for key, value in _STATE_CONF.items():
            spark.conf.set(key, value)
        try:
            # So that there is a table to read even if nothing has arrived.
            spark.createDataFrame([], _CLASSES).write.mode("overwrite").parquet(f"{folder}/classes/batch=-1")
            arrivals = spark.readStream.schema(_ARRIVAL).parquet(f"{folder}/arrivals")
            # A struct is largest by its first field, so by doc_id; the place makes the choice single.
            state = arrivals.groupBy("digest").agg(
                F.max(F.struct("doc_id", "file", "offset", "size")).alias("keeper"), F.count("*").alias("n"))

            def changed(batch: DataFrame, number: int) -> None:
                # A batch that is repeated after a failure overwrites its own folder.
                batch.write.mode("overwrite").parquet(f"{folder}/classes/batch={number}")

            state.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/checkpoint") \
                .trigger(availableNow=True).foreachBatch(changed).start().awaitTermination()
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)

    def arrivals(self) -> DataFrame:
        tables = self._tables()
        if not tables:
            raise ValueError("nothing has been added")
        rest = [f for f in self._columns(tables) if f.name != tables[0]["text"]]
        schema = T.StructType([*T.StructType.fromDDL(_ARRIVAL), T.StructField("rest", T.StructType(rest))])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/arrivals")

    def classes(self) -> DataFrame:
        """The newest state of each digest: digest, keeper (doc_id, file, offset, size), n."""
        history = self.spark.read.schema(_CLASSES).parquet(f"{self.folder}/classes")
        return history.groupBy("digest").agg(F.max_by("keeper", "n").alias("keeper"), F.max("n").alias("n"))

    # --- results -----------------------------------------------------------------------------------------------------

    def result(self) -> DataFrame:
        """Every arrival with its class: the columns of the arrivals, keeper and n."""
        here = F.struct(*_ORDER)
        marked = self.arrivals().join(self.classes(), "digest")
        hits = marked.filter((F.col("n") > 1) & (here != F.struct(*[F.col("keeper")[c] for c in _ORDER]))) \
            .select("digest", "file", "offset", "size", "keeper")
        wrong = stage(self._differing(hits), "collisions")
        if wrong.isEmpty():
            return marked
        return self._split(marked, wrong.select("digest").distinct())

    def _differing(self, hits: DataFrame) -> DataFrame:
        """The hits whose full bytes are not those of the content kept for their digest."""
        folder = self.folder

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = _Contents(folder).read
            kept_at, kept = None, b""
            for batch in batches:
                differ = []
                for r in batch.to_pylist():
                    if (place := (r["keeper"]["file"], r["keeper"]["offset"], r["keeper"]["size"])) != kept_at:
                        kept_at, kept = place, read(*place)
                    differ.append(read(r["file"], r["offset"], r["size"]) != kept)
                yield batch.filter(pa.array(differ, pa.bool_()))

        # Copies of one text are dealt out by the file they lie in, or one task would compare all copies of the commonest.
        return hits.repartition("keeper", "file").sortWithinPartitions("keeper", "file", "offset").mapInArrow(compare, hits.schema) \
            .select("digest", "file", "offset")

    def _split(self, marked: DataFrame, digests: DataFrame) -> DataFrame:
        """Classes anew, by full text, for digests under which different texts have met."""
        clash = self.with_text(marked.join(digests, "digest", "left_semi").drop("keeper", "n"))
        clash = stage(clash, "clashing")
        groups = clash.groupBy("digest", "content").agg(
            F.max(F.struct("doc_id", "file", "offset", "size")).alias("keeper"), F.count("*").alias("n"))
        again = clash.join(groups, ["digest", "content"]).select(*marked.columns)
        return marked.join(digests, "digest", "left_anti").select(*marked.columns).union(again)

    def with_text(self, rows: DataFrame) -> DataFrame:
        """Add ``content``, the stored bytes, to rows of arrivals."""
        folder = self.folder
        schema = T.StructType([*rows.schema, T.StructField("content", T.BinaryType())])

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = _Contents(folder).read
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    some = batch.slice(at, 256)
                    places = zip(*(some.column(some.schema.get_field_index(c)).to_pylist()
                                   for c in ("file", "offset", "size")))
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array([read(*p) for p in places], pa.binary())], schema.names)

        return rows.sortWithinPartitions("file", "offset").mapInArrow(fetch, schema)

    def survivors(self) -> DataFrame:
        """The rows that stay, with the columns they arrived with; their texts come from the content store."""
        here, kept = F.struct(*_ORDER), F.struct(*[F.col("keeper")[c] for c in _ORDER])
        rows = self.with_text(self.result().filter(here.eqNullSafe(kept)).drop("keeper", "n"))
        text = F.when(~F.col("was_null"), F.col("content").cast("string"))
        tables = self._tables()
        return rows.select(*[text.alias(c) if c == tables[0]["text"] else F.col("rest")[c].alias(c)
                             for c in self._columns(tables).names])


class _Contents:
    """The content store as one task reads it, with the files used last kept open."""

    def __init__(self, folder: str):
        self.store, self.root = open_store(folder)
        self.unpack = zstandard.ZstdDecompressor()
        self.open: dict[str, pa.NativeFile] = {}

    def read(self, file: str, offset: int, size: int) -> bytes:
        source = self.open.pop(file, None) or self.store.open_input_file(f"{self.root}/{file}")
        self.open[file] = source
        if len(self.open) > _OPEN_FILES:
            self.open.pop(next(iter(self.open))).close()
        return self.unpack.decompress(source.read_at(size, offset))


def mark_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", digest_chars: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of ``docs``.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest doc_id stays (a
    null doc_id is smaller than any other; of repeated rows exactly one is marked as kept). An empty table gives an
    empty result. Other columns are not read.
    """
    corpus = Deduplicator(docs.sparkSession, digest_chars=digest_chars)
    corpus.add(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")))
    corpus.update()
    here, kept = F.struct(*_ORDER), F.struct(*[F.col("keeper")[c] for c in _ORDER])
    return corpus.result().select(
        "doc_id", F.col("keeper.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        here.eqNullSafe(kept).alias("kept"), F.col("sha256").alias("text_sha256"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without exact copies, with its columns: of equal texts the row with the largest doc_id."""
    corpus = Deduplicator(docs.sparkSession)
    corpus.add(docs, text, doc_id)
    corpus.update()
    return corpus.survivors()


def copies_sql(source: str) -> str:
    """DuckDB SQL for the rows of ``mark_copies`` (doc_id unique)."""
    return f"""
    with base as (select doc_id, coalesce(text, '') as t from {source}),
    groups as (select t, max(doc_id) as keep_id, count(*) as group_size from base group by t)
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
    from base join groups using (t)"""
