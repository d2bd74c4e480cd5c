"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file is a plain zstandard stream. Each frame holds whole documents' ids (little-endian
unsigned 32-bit) and can be decompressed alone. Two skippable frames end the file: the
document index (ids and token counts, compressed) and the seek table of the public seekable
format, which has each frame's compressed size, decompressed size and a checksum (low 32 bits
of XXH64). A reader needs the end of the file and the frames of the documents it wants.

Defined results: null and empty texts are documents of the end id alone; null ids come first;
repeated ids are written one after another in the order of the input; a very long text is one
document in a frame of its own size; an empty table gives no file and no rows; other columns are neither
read nor returned.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.llm import tokens
from cliquespark.llm.shared import materialize, shared_path, texts

FRAME_TOKENS = 65_536
#: Text bytes and documents of a file at most, as far as ranges are even.
FILE_BYTES, FILE_DOCS = 256 << 20, 1 << 20
END_ID = 1
# Fixed values of the public seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "shard int, path string, n_docs long, n_tokens long, n_frames long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def open_any(path: str, mode: str):
    """A file by plain path, ``file:`` URI, or any URI that pyarrow knows."""
    if "://" not in path:
        path = path.removeprefix("file:")
        return open(path, mode)
    if path.startswith("file://"):
        return open(path.removeprefix("file://"), mode)
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_output_stream(inner) if "w" in mode else system.open_input_file(inner)


def make_folder(path: str) -> None:
    import os

    if path.startswith("file:") or "://" not in path:
        os.makedirs(path.removeprefix("file://").removeprefix("file:"), exist_ok=True)
    else:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner, recursive=True)


def publish(temporary: str, path: str) -> None:
    """Rename at the end, so that a lost or repeated task never leaves half a file."""
    import os

    if path.startswith("file:") or "://" not in path:
        bare = lambda p: p.removeprefix("file://").removeprefix("file:")
        os.replace(bare(temporary), bare(path))
    else:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(path)
        system.move(fs.FileSystem.from_uri(temporary)[1], inner)


class TokenFileWriter:
    """Writes documents in order; holds one frame in memory."""

    def __init__(self, stream, frame_tokens: int = FRAME_TOKENS, level: int = 3):
        import zstandard

        self.stream, self.limit = stream, frame_tokens * tokens.TOKEN_BYTES
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frame: list[bytes] = []
        self.size = 0
        self.seek: list[tuple[int, int, int]] = []
        self.docs: list[int] = []
        self.nulls: list[int] = []
        self.counts: list[int] = []
        self.frames: list[int] = []

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.nulls.append(doc_id is None)
        self.docs.append(doc_id or 0)
        self.counts.append(len(packed) // tokens.TOKEN_BYTES)
        self.frames.append(len(self.seek))
        self.frame.append(packed)
        self.size += len(packed)
        if self.size >= self.limit:
            self.flush()

    def flush(self) -> None:
        import xxhash

        if self.frame:
            data = b"".join(self.frame)
            body = self.zstd.compress(data)
            self.stream.write(body)
            self.seek.append((len(body), len(data), xxhash.xxh64(data).intdigest() & 0xFFFFFFFF))
            self.frame, self.size = [], 0

    def close(self) -> None:
        self.flush()
        index = self.zstd.compress(b"".join([np.array(self.docs, "<i8").tobytes(), np.array(self.nulls, "u1").tobytes(), np.array(self.counts, "<u4").tobytes(), np.array(self.frames, "<u4").tobytes()]))
        self.stream.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *x) for x in self.seek)
        footer = struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(footer)) + table + footer)


@dataclass
class TokenFile:
    """A file opened for reading: the seek table, the document index, and frames on request."""

    stream: object

    def __post_init__(self):
        self.stream.seek(0, 2)
        end = self.stream.tell()
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._at(end - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3)
        self.sizes, self.plain, self.sums = (table[:, k].astype(np.int64) for k in range(3))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        magic, size = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("no document index before the seek table")
        import zstandard

        self.zstd = zstandard.ZstdDecompressor()
        index = self.zstd.decompress(self._at(int(self.starts[-1]) + 8, size))
        n = len(index) // 17
        self.docs = np.frombuffer(index, "<i8", n)
        self.nulls = np.frombuffer(index, "u1", n, 8 * n).astype(bool)
        self.counts = np.frombuffer(index, "<u4", n, 9 * n).astype(np.int64)
        self.frames = np.frombuffer(index, "<u4", n, 13 * n).astype(np.int64)

    def _at(self, start: int, size: int) -> bytes:
        self.stream.seek(start)
        return self.stream.read(size)

    def frame(self, k: int) -> bytes:
        import xxhash

        data = self.zstd.decompress(self._at(int(self.starts[k]), int(self.sizes[k])))
        if len(data) != self.plain[k] or xxhash.xxh64(data).intdigest() & 0xFFFFFFFF != self.sums[k]:
            raise ValueError(f"frame {k} does not match its checksum")
        return data

    def read(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """``(doc_id, ids before it in this file, packed ids)``; only frames with a wanted document are read."""
        before = np.cumsum(self.counts) - self.counts
        keep = np.ones(len(self.docs), bool) if wanted is None else np.isin(self.docs, list(wanted)) & ~self.nulls
        for k in np.unique(self.frames[keep]):
            inside = np.flatnonzero(self.frames == k) if len(self.frames) < 64 else np.arange(np.searchsorted(self.frames, k), np.searchsorted(self.frames, k, "right"))
            data, at = self.frame(int(k)), 0
            for i in inside:
                size = int(self.counts[i]) * tokens.TOKEN_BYTES
                if keep[i]:
                    yield None if self.nulls[i] else int(self.docs[i]), int(before[i]), data[at : at + size]
                at += size


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID, n_files: int | None = None) -> DataFrame:
    """Write ``docs`` in ascending order of ``doc_id``, one file per range; returns the manifest.

    Without ``n_files`` there are as many as keep a file's share of texts and documents below ``FILE_BYTES``
    and ``FILE_DOCS``, and no fewer than shuffle partitions. Ranges go by id and place in the input, so that
    rows without an id, or of one id, can be in several files.
    """
    path, end = tokenizer_path or tokens.word_bpe_path(), tokens.pack_ids([end_id])
    spark = docs.sparkSession
    if n_files is None:
        size = texts(docs).agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
        n_files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["bytes"] // FILE_BYTES), -(-size["n"] // FILE_DOCS))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, out, stream = tokens.encoder(path), None, None
        context = TaskContext.get()
        shard = context.partitionId()
        final = f"{folder}/tokens-{shard:06d}.zst"
        temporary = f"{folder}/.tokens-{shard:06d}-{context.taskAttemptId()}"
        for batch in batches:
            for block in tokens.in_blocks(batch):
                if out is None:
                    make_folder(folder)
                    stream = open_any(temporary, "wb")
                    out = TokenFileWriter(stream)
                for (doc, _), packed in zip(block, coder.encode([t for _, t in block]), strict=True):
                    out.add(doc, packed + end)
        if out is not None:
            out.close()
            stream.close()
            publish(temporary, final)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [final], "n_docs": [len(out.docs)], "n_tokens": [sum(out.counts)], "n_frames": [len(out.seek)]})

    # a number of the row's own costs no reading of texts when ranges are sampled
    keyed = texts(docs).withColumn("row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(n_files, "doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    return materialize(ordered.mapInArrow(write, MANIFEST), "token-files")


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows ``doc_id, start, n_tokens, ids`` from the files of a manifest, one task per file; ``doc_ids``: only these, decompressing only their frames.

    The manifest has one row per file; it is brought to the driver to add up the earlier files' ids.
    """
    spark = manifest.sparkSession
    rows, base = [], 0
    for r in manifest.orderBy("shard").collect():
        rows.append((r["path"], base))
        base += r["n_tokens"]
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for path, first in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                with open_any(path, "rb") as stream:
                    out: tuple[list, ...] = ([], [], [], [])
                    size = 0
                    for doc, before, packed in TokenFile(stream).read(wanted):
                        for column, value in zip(out, (doc, first + before, len(packed) // tokens.TOKEN_BYTES, packed), strict=True):
                            column.append(value)
                        size += len(packed)
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
                            out, size = ([], [], [], []), 0
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows))).mapInArrow(read, DOCUMENTS)


def token_digests(docs: DataFrame) -> DataFrame:
    """The contract's rows, read back from the files."""
    folder = shared_path(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, folder)).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def read_documents(spark: SparkSession, manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    return read_token_files(manifest, doc_ids)
