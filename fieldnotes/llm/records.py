"""Token ids in length-delimited binary records with an offset index.

File: an 8-byte head (magic and id width), then one record per document:

    uint64 length | uint32 masked crc of the length | payload | uint32 masked crc of the payload

all little-endian. The payload is a flag byte (1: the key is NULL), the key
as int64, and the ids. The index file beside it holds the uint64 offset of
every record and a uint32 masked crc of all offsets, so that a reader can
fetch records in any order. A mask keeps checksums of data that itself holds
checksums apart: the crc32 is rotated by 15 bits and a constant is added.

Documents are dealt out by key range and each task streams its range into a
shard of its own in the shared folder, under a name of its own, so a task
that runs twice can't harm the other's file; the manifest names the shards of
the tasks that ended. Shards follow the order of the keys.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldnotes.llm.common import pa_schema, shared_path, small_batches, stage, text_of
from fieldnotes.llm.tokens import encoder

MAGIC = b"FNREC1"
MASK_ADD = 0xA282EAD8
BATCH = 512
READ_RUN = 8 << 20
MANIFEST = "shard int, path string, n_docs bigint, n_tokens bigint, n_bytes bigint"
BACK = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def payload_of(key: int | None, ids: bytes) -> bytes:
    return struct.pack("<Bq", key is None, key or 0) + ids


def unframe(buffer: bytes, at: int = 0) -> tuple[bytes, int]:
    """(payload, offset of the next record); ValueError on damage."""
    if at + 12 > len(buffer):
        raise ValueError(f"record at {at}: cut off")
    size = buffer[at:at + 8]
    if struct.unpack_from("<I", buffer, at + 8)[0] != masked(size):
        raise ValueError(f"record at {at}: wrong checksum of the length")
    end = at + 12 + struct.unpack("<Q", size)[0]
    payload = buffer[at + 12:end]
    if end + 4 > len(buffer) or struct.unpack_from("<I", buffer, end)[0] != masked(payload):
        raise ValueError(f"record at {at}: wrong checksum of the payload")
    return payload, end + 4


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI that names its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    uri = at.getFileSystem(conf).makeQualified(at).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and uri[6:7] != "/" else uri


class ShardWriter:
    """Streams records into ``<path>.rec`` and their offsets into ``<path>.idx``."""

    def __init__(self, uri: str, width: int):
        self.store, self.path = open_store(uri)
        self.store.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.store.open_output_stream(f"{self.path}.rec")
        self.at = self.out.write(MAGIC + struct.pack("<H", width))
        self.offsets: list[int] = []

    def add(self, payload: bytes) -> None:
        self.offsets.append(self.at)
        self.at += self.out.write(frame(payload))

    def close(self) -> None:
        self.out.close()
        index = np.array(self.offsets, "<u8").tobytes()
        with self.store.open_output_stream(f"{self.path}.idx") as out:
            out.write(index + struct.pack("<I", masked(index)))


class ShardReader:
    """Records of a shard: in order, or by number through the index."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        with store.open_input_stream(f"{path}.idx") as f:
            index = f.read()
        if struct.unpack("<I", index[-4:])[0] != masked(index[:-4]):
            raise ValueError(f"{uri}.idx: wrong checksum")
        self.offsets = np.frombuffer(index[:-4], "<u8").astype(np.int64)
        self.file = store.open_input_file(f"{path}.rec")
        self.end = self.file.size()
        head = self.file.read(8)
        if head[:6] != MAGIC:
            raise ValueError(f"{uri}.rec: not a record file")
        self.dtype = f"<u{struct.unpack('<H', head[6:])[0]}"

    def __len__(self) -> int:
        return len(self.offsets)

    def __getitem__(self, n: int) -> tuple[int | None, np.ndarray]:
        self.file.seek(int(self.offsets[n]))
        stop = self.offsets[n + 1] if n + 1 < len(self) else self.end
        return self.decode(unframe(self.file.read(int(stop - self.offsets[n])))[0])

    def decode(self, payload: bytes) -> tuple[int | None, np.ndarray]:
        null, key = struct.unpack_from("<Bq", payload)
        return None if null else key, np.frombuffer(payload, self.dtype, offset=9)

    def runs(self) -> Iterator[list[tuple[int | None, np.ndarray]]]:
        """All records in order, some megabytes at a time."""
        at, n = 0, len(self)
        while at < n:
            first = int(self.offsets[at])
            to = max(at + 1, int(np.searchsorted(self.offsets, first + READ_RUN)))
            stop = int(self.offsets[to]) if to < n else self.end
            self.file.seek(first)
            data, pos, out = self.file.read(stop - first), 0, []
            for k in range(at, to):
                if pos != self.offsets[k] - first:
                    raise ValueError(f"record {k}: not where the index says")
                payload, pos = unframe(data, pos)
                out.append(self.decode(payload))
            yield out
            at = to


def write_records(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0) -> DataFrame:
    """Write all documents in key order below ``path``; returns the manifest,
    one row per shard in that order. Texts that are NULL count as empty; NULL
    keys come first; rows with equal keys are ordered by their text."""
    spark = docs.sparkSession
    small_batches(spark, BATCH)
    uri = qualified(spark, path)
    schema = pa_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = enc.pack([end_id])
        shard, name, writer, tokens = None, "", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                shard = batch.column(2)[0].as_py()
                name = f"{uri}/shard-{shard:06d}-{uuid.uuid4().hex}"
                writer = ShardWriter(name, enc.width)
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.encode(text) + end
                tokens += len(ids) // enc.width
                writer.add(payload_of(key, ids))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": name, "n_docs": len(writer.offsets), "n_tokens": tokens,
                  "n_bytes": writer.at}], schema=schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
               .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
               .select("doc_id", "text", F.spark_partition_id().alias("shard")))
    return stage(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_records(manifest: DataFrame) -> DataFrame:
    """Key, ids before it, number of ids and their checksum for every record,
    from the files."""
    spark = manifest.sparkSession
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    schema = pa_schema(BACK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for records in ShardReader(path).runs():
                    rows = []
                    for key, ids in records:
                        rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(n).mapInArrow(run, BACK)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = shared_path(docs.sparkSession, "records")
    return read_records(write_records(docs, tokenizer, path))
