"""Token ids as Arrow files of equal-length sequences with masks.

``write`` puts a table's token ids, in ascending id order, into Arrow IPC files (the stream of
record batches with the footer that gives each batch's place). Every batch holds
``BATCH_SEQUENCES`` sequences as two fixed-size lists of ``length``: ``ids`` and ``mask``. A
fixed-size list has no offsets, so the values of a batch are one contiguous buffer and any
sequence, or any run of tokens, is a slice of the mapped file: ``sequence`` and
``read_documents`` copy nothing to find it. A file is one range of ids and starts a new
sequence; its last sequence is padded, and the mask is false on padding. Beside the files lies
``index``: for each document its file, its place there and its length.

Each task writes its file under a private name and moves it into place, so a lost or repeated
attempt leaves the same bytes. The order is by (id, hash of the text), nulls first; rows equal
in both are interchangeable.

Defined cases: a null or empty text has only the end id; a text longer than a sequence runs on
through the following ones; ids are stored as 16-bit numbers if the vocabulary allows; an
empty table gives no file and an empty index; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, scratch_path, slices, texts_of
from feedlens.llm.word_ids import encoder

LENGTH, BATCH_SEQUENCES = 2048, 128
INDEX = "shard int, doc_id bigint, position bigint, n_tokens bigint"


def _arrow_type(vocabulary: int):
    import pyarrow as pa

    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


class _Shard:
    """One file: ids go in, whole batches of sequences go out."""

    def __init__(self, path: str, shard: int, attempt: int, kind, length: int):
        import pyarrow as pa
        from pyarrow import fs

        self.store, root = fs.FileSystem.from_uri(path)
        self.store.create_dir(f"{root}/shards", recursive=True)
        self.final, self.private = f"{root}/shards/{shard:06d}.arrow", f"{root}/shards/_{shard:06d}.{attempt}"
        self.kind, self.length, self.written, self.held, self.waiting = kind, length, 0, [], 0
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sink = self.store.open_output_stream(self.private)
        self.writer = pa.ipc.new_file(self.sink, self.schema)

    def add(self, ids: bytes) -> int:
        """Append ids (32-bit bytes); their place in the file."""
        import numpy as np

        place = self.written + self.waiting
        self.held.append(np.frombuffer(ids, "<u4").astype(self.kind.to_pandas_dtype()))
        self.waiting += len(ids) // 4
        whole = BATCH_SEQUENCES * self.length
        if self.waiting >= whole:
            values = np.concatenate(self.held)
            cut = len(values) // whole * whole
            for at in range(0, cut, whole):
                self._batch(values[at : at + whole], whole)
            self.held, self.waiting, self.written = [values[cut:]], len(values) - cut, self.written + cut
        return place

    def _batch(self, values, real: int) -> None:
        import numpy as np
        import pyarrow as pa

        columns = [pa.array(values, self.kind), pa.array(np.arange(len(values)) < real)]
        self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(c, self.length) for c in columns], schema=self.schema))

    def close(self) -> None:
        import numpy as np

        if self.waiting:
            values = np.concatenate(self.held)
            self._batch(np.pad(values, (0, -len(values) % self.length)), len(values))
        self.writer.close()
        self.sink.close()
        keep_first(self.store, self.private, self.final)


def keep_first(store, private: str, final: str) -> None:
    """Move a finished file to its name, unless an earlier attempt of the same task has left its
    (equal) file there; some stores refuse to move onto a file."""
    from pyarrow import fs

    there = lambda: store.get_file_info(final).type == fs.FileType.File
    if not there():
        try:
            store.move(private, final)
            return
        except OSError:
            if not there():  # not another attempt's doing
                raise
    store.delete_file(private)


def vocabulary_size(tokenizer: str, end_id: int) -> int:
    """One more than the largest id that is written."""
    from tokenizers import Tokenizer

    return 1 + max(end_id, *Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())


def write(df: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Write the files and the index under ``path``; the index as a DataFrame."""
    end = end_id.to_bytes(4, "little")

    def put(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task, shard, kind = TaskContext.get(), None, _arrow_type(vocabulary)
        ids_of = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                shard = shard or _Shard(path, task.partitionId(), task.taskAttemptId(), kind, length)
                encoded = [x + end for x in ids_of.encode(texts_of(part))]
                places = [shard.add(x) for x in encoded]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task.partitionId()] * len(places), pa.int32()), part.column(0), pa.array(places, pa.int64()), pa.array([len(x) // 4 for x in encoded], pa.int64())],
                    names=["shard", "doc_id", "position", "n_tokens"],
                )
        if shard:
            shard.close()

    chosen = bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").withColumn("tie", F.xxhash64("text"))
    ordered = chosen.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(put, INDEX).write.parquet(f"{path}/index")
    return df.sparkSession.read.schema(INDEX).parquet(f"{path}/index")


def open_shard(path: str, shard: int):
    """The record batches of a file, mapped where the store is local."""
    import pyarrow as pa
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path)
    name = f"{root}/shards/{shard:06d}.arrow"
    return pa.ipc.open_file(pa.memory_map(name) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(name))


def sequence(path: str, shard: int, row: int):
    """Ids and mask of one sequence: views of the file, found from the footer alone."""
    reader = open_shard(path, shard)
    batch = reader.get_batch(row // BATCH_SEQUENCES)
    at = row % BATCH_SEQUENCES
    return batch.column(0)[at].values, batch.column(1)[at].values


def read_documents(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian 32-bit bytes) of each document, from the
    files; ``start`` counts the ids of all documents before it."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    base = totals.select("shard", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("base"))
    placed = index.join(base, "shard").repartition("shard").sortWithinPartitions("shard", "position")

    def get(batches):
        import numpy as np
        import pyarrow as pa

        whole, opened, batch_at, values = BATCH_SEQUENCES * length, (None, None), None, None
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("shard", "position", "n_tokens")), strict=True)
            out, size, first = [], 0, 0
            for k, (shard, position, n) in enumerate(rows):
                if opened[0] != shard:
                    opened, batch_at = (shard, open_shard(path, shard)), None
                parts, at = [], position
                while at < position + n:
                    if batch_at != at // whole:
                        batch_at = at // whole
                        values = opened[1].get_batch(batch_at).column(0).values.to_numpy()
                    here = at - batch_at * whole
                    parts.append(values[here : min(whole, here + position + n - at)])
                    at += len(parts[-1])
                out.append(np.concatenate(parts).astype("<u4").tobytes() if parts else b"")
                size += len(out[-1])
                if size > 8_000_000 or k == batch.num_rows - 1:
                    part = batch.slice(first, k + 1 - first)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("start"), part.column("n_tokens"), pa.array(out, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                    out, size, first = [], 0, k + 1

    chosen = placed.select("shard", "position", "doc_id", (F.col("base") + F.col("position")).alias("start"), "n_tokens")
    return chosen.mapInArrow(get, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_binary(df: DataFrame, tokenizer: str, vocabulary: int | None, end_id: int) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back; without a ``vocabulary`` its
    size is the tokenizer's."""
    path = scratch_path(df.sparkSession, "token-binary")
    write(df, path, tokenizer, vocabulary or vocabulary_size(tokenizer, end_id), end_id)
    return read_documents(df.sparkSession, path)
