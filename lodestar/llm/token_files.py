"""Token ids in seekable zstandard files.

File: one independent zstandard frame per document (its ids as little-endian
unsigned 16-bit integers, or 32-bit if the vocabulary needs them), then two
skippable frames.  The first holds the width of an id in bytes and the
documents' ids; the second is the seek table of the public seekable format:
compressed size, size and checksum of every frame (the low 32 bits of the
XXH64 of its content), the number of frames and a closing magic number.  Any
zstandard tool reads such a file; a reader that knows the table decompresses
only the frames of the documents it wants and checks each.

Writing.  Texts are encoded where they are read; ids are then dealt out by
range of (doc_id, hash of the ids), sorted, and each partition is written to
one file in a shared folder; their number follows from the compressed bytes
(``FILE_BYTES``), with one for each core at least.  A try writes under a name of its own; the list
of files is kept as a checkpoint, which takes one try of each task only, so
lost executors leave stray files at most.  Paths go through ``pyarrow.fs``
(file, hdfs, s3 and others).

Defined results: null text counts as empty and gives the end id alone; null
document ids come first; equal ids are ordered by content; a document of any
length is one frame; an empty table gives no files and no rows; other columns
are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestar.llm.bpe import codec, text_slices
from lodestar.llm.common import cut, shared_folder, ship

# Fixed values of the public zstandard formats.
SKIPPABLE_DOCS = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

LEVEL = 1
FILE_BYTES = 1 << 27  # compressed bytes of a file, about
READ_BYTES = 1 << 22  # read at a time by a scan of a whole file
NO_ID = -(1 << 63)  # stands for a null document id inside a file


def open_fs(path: str):
    """File system and path inside it; a plain path is a local or mounted one."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def packer(width: int):
    """(ids of documents, their token ids as bytes) -> a batch of id, checksum,
    n_tokens, frame; frames are compressed before the shuffle."""
    z = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def pack(ids: pa.Array, raw: list[bytes]) -> pa.RecordBatch:
        sums = np.array([xxhash.xxh64_intdigest(x) for x in raw], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(sums), pa.array([len(x) // width for x in raw], pa.int64()),
             pa.array([z.compress(x) for x in raw], pa.binary())], ["id", "checksum", "n_tokens", "frame"])
    return pack


def write_file(folder: str, width: int):
    """One file per partition from sorted rows; yields its description."""
    def run(batches):
        fs = out = None
        ids, entries, tokens = array("q"), array("Q"), 0
        name = f"{folder}/{uuid.uuid4().hex}.zst"
        for batch in batches:
            for doc, checksum, n, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs, where = open_fs(name)
                    fs.create_dir(where.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(where, compression=None)
                out.write(frame)
                ids.append(NO_ID if doc is None else doc)
                entries.extend((len(frame), n * width, checksum & 0xFFFFFFFF))
                tokens += n
        if out is None:
            return
        docs = struct.pack("<I", width) + np.array(ids, "<i8").tobytes()
        out.write(struct.pack("<II", SKIPPABLE_DOCS, len(docs)) + docs)
        table = np.array(entries, "<u4").tobytes() + struct.pack("<IBI", len(ids), CHECKSUM_FLAG, SEEK_MAGIC)
        out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)
        out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([len(ids)], pa.int64()), pa.array([tokens], pa.int64())],
            ["file", "n_docs", "n_tokens"])
    return run


class Reader:
    """Random access to one file: ``docs`` (ids), ``sizes`` (tokens of each),
    and ``read`` for any of them; only those frames are read and decompressed."""

    def __init__(self, path: str):
        fs, where = open_fs(path)
        self.file = fs.open_input_file(where)
        size = self.file.size()
        n, flag, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError(f"{path} has no seek table")
        self.table = np.frombuffer(self.file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        head = self.file.read_at(12 + 8 * n, int(self.offsets[-1]))
        kind, length, self.width = struct.unpack("<III", head[:12])
        if kind != SKIPPABLE_DOCS or length != 4 + 8 * n:
            raise ValueError(f"{path} has no document list")
        self.docs = np.frombuffer(head[12:], "<i8")
        self.sizes = self.table[:, 1].astype(np.int64) // self.width
        self.zstd = zstandard.ZstdDecompressor()

    def read(self, k: int) -> np.ndarray:
        """Ids of the k-th document, as unsigned 32-bit integers."""
        return self._open(k, self.file.read_at(int(self.table[k, 0]), int(self.offsets[k])))

    def scan(self):
        """Ids of all documents in order; frames are read many at a time."""
        at = 0
        while at < len(self.docs):
            end = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + READ_BYTES, "right")) - 1)
            data = memoryview(self.file.read_at(int(self.offsets[end] - self.offsets[at]), int(self.offsets[at])))
            for k in range(at, end):
                a = int(self.offsets[k] - self.offsets[at])
                yield self._open(k, data[a:a + int(self.table[k, 0])])
            at = end

    def _open(self, k: int, frame) -> np.ndarray:
        raw = self.zstd.decompress(frame, max_output_size=int(self.table[k, 1]))
        if len(raw) != self.table[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"document {k}: frame is damaged")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def find(self, doc_id: int) -> list[int]:
        """Places of a document; the list is sorted."""
        a, b = np.searchsorted(self.docs, (doc_id, doc_id + 1))
        return list(range(int(a), int(b)))


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", files: int | None = None) -> DataFrame:
    """Encode, write, and return the list of files: file, first_doc, n_docs,
    n_tokens, first (tokens before the file), in ascending order of document id."""
    spark = docs.sparkSession
    vocabulary = max(len(codec(path).token_bytes), (end_id or 0) + 1)
    width = 2 if vocabulary <= 1 << 16 else 4
    wide = ship(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    end = b"" if end_id is None else np.array([end_id], f"<u{width}").tobytes()
    def encode_and_pack(batches):
        c, pack = codec(path), packer(width)
        for batch in batches:
            for at, texts in text_slices(batch):
                flat, ends = c.encode_flat(texts)
                raw, ends = flat.astype(f"<u{width}").tobytes(), [0, *(ends * width).tolist()]
                yield pack(batch.column(0).slice(at, len(texts)), [raw[a:b] + end for a, b in zip(ends, ends[1:])])

    # Range partitioning reads its input twice (once for a sample), so encode before it.
    rows = cut(wide.mapInArrow(encode_and_pack, "id long, checksum long, n_tokens long, frame binary"))
    if not files:
        size = rows.agg(F.sum(F.length("frame"))).first()[0] or 0
        files = max(-(-size // FILE_BYTES), spark.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(files, F.col("id").asc_nulls_first(), "checksum")
    dealt = dealt.sortWithinPartitions(F.col("id").asc_nulls_first(), "checksum")
    done = dealt.mapInArrow(write_file(folder, width), "file string, n_docs long, n_tokens long")
    done = cut(done.withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return done.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    def run(batches):
        for batch in batches:
            for name, first in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
                r = Reader(name)
                starts = first + np.concatenate([[0], np.cumsum(r.sizes)[:-1]]).astype(np.int64)
                crcs = (zlib.crc32(x) for x in r.scan())
                for a in range(0, len(r.docs), 4096):
                    part = slice(a, a + 4096)
                    crc = list(islice(crcs, 4096))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r.docs[part], mask=r.docs[part] == NO_ID), pa.array(starts[part]),
                         pa.array(r.sizes[part]), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (ship(files).select("file", "first").repartition(n, "file")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def fetch(files: DataFrame, wanted: list[int]) -> DataFrame:
    """Ids of the wanted documents: (doc_id, ids); other frames are not read."""
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                r = Reader(name)
                got = [(d, r.read(k).astype(np.int32)) for d in wanted for k in r.find(d)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in got], pa.int64()), pa.array([x for _, x in got], pa.list_(pa.int32()))],
                    ["doc_id", "ids"])

    return ship(files).select("file").mapInArrow(run, "doc_id long, ids array<int>")


def token_file_report(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    folder = shared_folder(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, path, folder, end_id, id_col, text_col))

