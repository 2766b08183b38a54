"""Operator 10: token ids as Arrow stream files of equal-length sequences.

The ids of all documents, in ascending doc_id order, form one stream.  It is
cut by doc_id ranges into parts; each part is one Arrow IPC file whose record
batches hold fixed-size lists, ``tokens`` (uint16, or uint32 for a vocabulary
above 65,536) and ``mask`` (true for ids, false for the padding that ends a
part), so any sequence is a slice of a memory map, without a copy.  Beside it
lies an index file with doc_id, start and n_tokens of the part's documents.

A task writes files under a name of its own and reports them in its output
row; only reported files count, so a repeated task leaves no double.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_bucket, id_bounds, materialize, packed_texts, running_totals, shared_dir, unpack
from .encoding import encoder

#: Length of a sequence, and sequences in a record batch.
SEQUENCE, BATCH = 2048, 64


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as Spark's own file system settings resolve it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _file_system(uri: str):
    """pyarrow's file system and path for a qualified folder (file:, hdfs:, s3: ...)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class _PartWriter:
    """Writes one part: sequences as they fill, then the index."""

    def __init__(self, folder: str, dtype: np.dtype, length: int):
        self.fs, path = _file_system(folder)
        self.fs.create_dir(path)
        self.length, self.dtype, self.name = length, dtype, uuid.uuid4().hex
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = self.fs.open_output_stream(f"{path}/{self.name}.arrow")
        self.index_out = self.fs.open_output_stream(f"{path}/{self.name}.index.arrow")
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.held, self.size, self.total, self.docs, self.starts = [], 0, 0, [], []

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.total)
        self.held.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= self.length * BATCH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.dtype)
        step = self.length if last else self.length * BATCH  # only a part's last record batch may be smaller
        full = len(flat) // step * step
        rest = flat[full:]
        if last and len(rest):
            mask = np.arange(full + self.length) < len(flat)
            flat = np.concatenate([flat, np.zeros(self.length - len(rest), self.dtype)])
            full += self.length
        else:
            mask = np.ones(full, bool)
        for at in range(0, full, self.length * BATCH):
            end = min(full, at + self.length * BATCH)
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[at:end]), self.length) for x in (flat, mask)]
            self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.held, self.size = ([] if last else [rest]), (0 if last else len(rest))

    def close(self) -> tuple[str, int, int]:
        self._flush(True)
        self.writer.close()
        self.out.close()
        index = pa.table({"doc_id": pa.array(self.docs, pa.int64()), "start": pa.array(self.starts, pa.int64()), "n_tokens": pa.array(np.diff([*self.starts, self.total]), pa.int64())})
        with pa.ipc.new_file(self.index_out, index.schema) as w:
            w.write_table(index)
        self.index_out.close()
        return self.name, len(self.docs), self.total


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, length: int = SEQUENCE) -> DataFrame:
    """Write the token files of ``docs`` below ``folder``; return their manifest.

    Manifest: bucket, folder, name, n_docs, n_tokens, one row per part, in the
    stream's order by bucket.  Documents are in ascending doc_id order, null
    ids first, ties by text; null texts count as empty and every document ends
    with ``end_id``.  An empty table writes nothing.
    """
    folder = qualified(docs.sparkSession, folder or shared_dir(docs.sparkSession, "tokens"))
    bounds, n = id_bounds(docs, "doc_id")

    def run(batches):
        own, writer, current, rows = encoder(tokenizer), None, None, []
        wide = max(own.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
        dtype = np.dtype("<u4" if wide else "<u2")
        for batch in batches:
            for bucket, doc_id, body in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "body"))):
                if bucket != current:
                    if writer:
                        rows.append((current, *writer.close()))
                    writer, current = _PartWriter(folder, dtype, length), bucket
                ids = np.frombuffer(own.encode(unpack(body)), "<u4")
                writer.add(doc_id, np.append(ids, end_id).astype(dtype))
        if writer:
            rows.append((current, *writer.close()))
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["bucket", "name", "n_docs", "n_tokens"]
        )

    ordered = by_bucket(packed_texts(docs, bounds), "bucket", n).sortWithinPartitions("bucket", F.asc_nulls_first("doc_id"), "body")
    return materialize(ordered.mapInArrow(run, "bucket int, name string, n_docs long, n_tokens long").withColumn("folder", F.lit(folder)), "manifest")


class TokenFile:
    """Random access to one part: sequences and documents by number."""

    def __init__(self, folder: str, name: str):
        fs, path = _file_system(folder)
        local = type(fs).__name__ == "LocalFileSystem"
        source = pa.memory_map(f"{path}/{name}.arrow") if local else fs.open_input_file(f"{path}/{name}.arrow")
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("tokens").type.list_size
        with fs.open_input_file(f"{path}/{name}.index.arrow") as f:
            self.index = pa.ipc.open_file(f).read_all()
        self._at, self._batch = None, None

    def _load(self, number: int) -> pa.RecordBatch:
        if self._at != number:
            self._at, self._batch = number, self.reader.get_batch(number)
        return self._batch

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, mask) of a sequence; tokens are a view of the file."""
        batch, at = self._load(number // BATCH), number % BATCH
        return batch.column("tokens")[at].values.to_numpy(), batch.column("mask")[at].values.to_numpy(zero_copy_only=False)

    def stream(self, start: int, stop: int):
        """Views that together are the ids from start to stop."""
        step = self.length * BATCH
        while start < stop:
            tokens = self._load(start // step).column("tokens").flatten().to_numpy()
            low = start % step
            part = tokens[low : low + stop - start]
            if not len(part):
                raise ValueError(f"the file ends before id {start}")
            yield part
            start += len(part)


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files of a manifest."""
    # One row per part; a part holds what one task of the shuffle holds.
    placed = running_totals(manifest.select("bucket", "folder", "name", "n_tokens"), "bucket", "n_tokens", "first").select("bucket", "folder", "name", "first")

    def run(batches):
        for batch in batches:
            for folder, name, first in zip(*(batch.column(c).to_pylist() for c in ("folder", "name", "first"))):
                part = TokenFile(folder, name)
                starts, sizes = (part.index.column(c).to_numpy() for c in ("start", "n_tokens"))
                crcs = []
                for start, size in zip(starts.tolist(), sizes.tolist()):
                    crc = 0
                    for view in part.stream(start, start + size):
                        crc = zlib.crc32(view.astype("<u4"), crc)
                    crcs.append(crc)
                yield pa.RecordBatch.from_arrays(
                    [part.index.column("doc_id").combine_chunks(), pa.array(starts + first), pa.array(sizes), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return by_bucket(placed, "bucket", max(1, manifest.count())).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
