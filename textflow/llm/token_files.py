"""Token ids in seekable zstandard files.

A file holds the ids of a range of documents in ascending id order:

* data frames: independent zstandard frames of at most ``FRAME_BYTES`` of
  little-endian unsigned ids (2 or 4 bytes each, by vocabulary size);
* an index frame, skippable: document ids and token counts;
* the seek table, the last skippable frame: compressed size, size and
  XXH64-low-32 checksum of every data frame, the number of frames, and the
  magic number of the seekable format.

A reader fetches the end of a file, finds the frames that hold the wanted
documents, and decompresses and checks only these.

Files are written under the shared checkpoint folder by the tasks that sort
the documents; an attempt writes under a name of its own, and the manifest,
a table committed by Spark, names the files that count.  So a lost executor
or a repeated task leaves at most a file that nobody reads.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import partitions, written
from textflow.llm.words import chunk_runs
from textflow.llm.wordpiece import (chunk_memo, encode_whole, has_added,
                                    library)
from textflow.plans.lineage import scratch_path

FRAME_BYTES = 256 << 10
LEVEL = 3
# fixed values of the zstandard seekable format
SKIPPABLE = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


class TokenFileWriter:
    """Writes one file; documents come in order."""

    def __init__(self, out, item_bytes: int) -> None:
        self._out, self._dtype = out, np.dtype(f"<u{item_bytes}")
        self._zstd = zstandard.ZstdCompressor(level=LEVEL)
        self._waiting: list[np.ndarray] = []
        self._bytes = 0
        self._entries: list[bytes] = []
        self._ids: list[int | None] = []
        self._counts: list[int] = []
        self.n_tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._ids.append(doc_id)
        self._counts.append(len(ids))
        self.n_tokens += len(ids)
        ids = ids.astype(self._dtype)
        room = FRAME_BYTES // self._dtype.itemsize
        for lo in range(0, len(ids), room):     # a long document: many frames
            part = ids[lo:lo + room]
            if self._bytes and self._bytes + part.nbytes > FRAME_BYTES:
                self._frame()
            self._waiting.append(part)
            self._bytes += part.nbytes

    def _frame(self) -> None:
        if not self._bytes:
            return
        raw = np.concatenate(self._waiting).tobytes()
        packed = self._zstd.compress(raw)
        self._out.write(packed)
        self._entries.append(ENTRY.pack(
            len(packed), len(raw),
            xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self._waiting, self._bytes = [], 0

    def close(self) -> None:
        self._frame()
        table = pa.table({"doc_id": pa.array(self._ids, pa.int64()),
                          "n_tokens": pa.array(self._counts, pa.int64())})
        body = io.BytesIO()
        with pa.ipc.new_stream(body, table.schema) as w:
            w.write_table(table)
        index = self._zstd.compress(body.getvalue())
        self._out.write(_skippable(INDEX_FRAME, index))
        self._out.write(_skippable(SKIPPABLE, b"".join(self._entries)
                                   + FOOTER.pack(len(self._entries),
                                                 CHECKSUM_FLAG,
                                                 SEEKABLE_MAGIC)))
        self._out.close()


class TokenFileReader:
    """Random and sequential access to one file."""

    def __init__(self, uri: str, item_bytes: int) -> None:
        store, path = open_store(uri)
        self._in = store.open_input_file(path)
        self._dtype = np.dtype(f"<u{item_bytes}")
        self._zstd = zstandard.ZstdDecompressor()
        size = self._in.size()
        n, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size,
                                                 FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{uri}: no seek table with checksums")
        begin = size - FOOTER.size - n * ENTRY.size
        self.entries = list(ENTRY.iter_unpack(self._at(begin,
                                                       n * ENTRY.size)))
        self.data_end = sum(e[0] for e in self.entries)
        magic, length = struct.unpack("<II", self._at(self.data_end, 8))
        if magic != INDEX_FRAME:
            raise ValueError(f"{uri}: no index frame")
        body = self._zstd.decompress(self._at(self.data_end + 8, length))
        index = pa.ipc.open_stream(body).read_all()
        self.doc_ids = index["doc_id"].to_pylist()
        self.counts = index["n_tokens"].to_numpy()
        self.begins = np.cumsum(self.counts) - self.counts
        self._frame_at = np.cumsum([0] + [e[0] for e in self.entries])
        item = self._dtype.itemsize
        self._token_at = np.cumsum([0] + [e[1] // item
                                          for e in self.entries])
        self.frames_read = 0

    def _at(self, offset: int, length: int) -> bytes:
        self._in.seek(offset)
        return self._in.read(length)

    def frame(self, k: int) -> np.ndarray:
        packed, size, check = self.entries[k]
        raw = self._zstd.decompress(
            self._at(int(self._frame_at[k]), packed), max_output_size=size)
        if len(raw) != size or (xxhash.xxh64_intdigest(raw)
                                & 0xFFFFFFFF) != check:
            raise ValueError(f"frame {k}: checksum differs")
        self.frames_read += 1
        return np.frombuffer(raw, self._dtype)

    def tokens(self, number: int) -> np.ndarray:
        """Ids of the document with this number in the file."""
        lo = int(self.begins[number])
        hi = lo + int(self.counts[number])
        if lo == hi:
            return np.zeros(0, self._dtype)
        first = int(np.searchsorted(self._token_at, lo, "right")) - 1
        last = int(np.searchsorted(self._token_at, hi, "left")) - 1
        got = np.concatenate([self.frame(k)
                              for k in range(first, last + 1)])
        base = int(self._token_at[first])
        return got[lo - base:hi - base]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, first token, ids) in order; one frame is held at a time."""
        k, have, base = 0, np.zeros(0, self._dtype), 0
        for doc, lo, n in zip(self.doc_ids, self.begins, self.counts,
                              strict=True):
            have, base = have[lo - base:], int(lo)
            parts, size = [have], len(have)
            while size < n:
                parts.append(self.frame(k))
                size += len(parts[-1])
                k += 1
            if len(parts) > 1:
                have = np.concatenate(parts)
            yield doc, int(lo), have[:n]

    def close(self) -> None:
        self._in.close()


MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("file",
                                                          T.StringType()),
    T.StructField("n_docs", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("item_bytes", T.IntegerType())])


def _write(base: str, tokenizer: str, end_id: int, item_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = chunk_memo(tokenizer)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        writer, uri, n_docs = None, "", 0
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1)
            special = has_added(texts, tokenizer)
            for r in chunk_runs(texts, True, False):
                ids, off = memo.ids(r)
                for i in range(r.rows):
                    if writer is None:
                        uri = (f"{base}/tokens-{part:06d}-"
                               f"{uuid.uuid4().hex}.zst")
                        store, path = open_store(uri)
                        store.create_dir(path.rsplit("/", 1)[0])
                        writer = TokenFileWriter(
                            store.open_output_stream(path, compression=None),
                            item_bytes)
                    own = ids[off[i]:off[i + 1]]
                    at = r.first + i
                    if special[at]:
                        own = np.array(encode_whole(
                            tokenizer, texts[at].as_py()), np.uint32)
                    writer.add(keys[at], np.concatenate([own, end]))
                    n_docs += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [uri],
                 "n_docs": [n_docs], "n_tokens": [writer.n_tokens],
                 "item_bytes": pa.array([item_bytes], pa.int32())})

    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text"
                      ) -> DataFrame:
    """Encode ``docs`` and write token files; returns the manifest, one row
    per file in document order (``part`` ascending) with the number of
    tokens in the files before it (``file_start``).

    Null text counts as empty (only the end id); rows with a null id come
    first; rows with the same id are ordered by a hash of their text.
    """
    spark = docs.sparkSession
    item_bytes = 2 if library(tokenizer).get_vocab_size() <= 1 << 16 else 4
    base = scratch_path(spark, "tokens")
    order = ["id", "_h", "text"]
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.col(text_col).alias("text")).withColumn(
        "_h", F.xxhash64("text"))
    rows = rows.repartitionByRange(partitions(spark), "id", "_h")
    rows = rows.sortWithinPartitions(*order).select("id", "text")
    manifest = written(rows.mapInArrow(
        _write(base, tokenizer, end_id, item_bytes), MANIFEST), "manifest")
    # one row per file: as many as range partitions
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("file_start", F.coalesce(
        F.sum("n_tokens").over(w), F.lit(0)))


_READ = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start",
                                                         T.LongType()),
    T.StructField("n_tokens", T.LongType())])
_CHUNK = 2000


def _read(digest: bool, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m in b.to_pylist():
                reader = TokenFileReader(m["file"], m["item_bytes"])
                rows: list[tuple] = []

                def out():
                    return pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(
                            zip(*rows, strict=True), like, strict=True)],
                        schema=like)

                for doc, lo, ids in reader.documents():
                    rows.append((doc, m["file_start"] + lo, len(ids),
                                 zlib.crc32(ids.astype("<u4").tobytes())
                                 if digest else ids.astype(np.int64)))
                    if len(rows) >= _CHUNK:
                        yield out()
                        rows.clear()
                if rows:
                    yield out()
                reader.close()

    return run


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """Documents of all files: ``doc_id, start, n_tokens`` and ``ids``, or
    with ``digest`` their ``ids_crc32``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    n = partitions(manifest.sparkSession)
    schema = T.StructType([*_READ.fields, T.StructField(
        "ids_crc32", T.LongType()) if digest else T.StructField(
        "ids", T.ArrayType(T.LongType()))])
    dealt = manifest.repartitionById(n, F.pmod("part", F.lit(n)).cast("int"))
    return dealt.mapInArrow(_read(digest, to_arrow_schema(schema)), schema)


def fetch(manifest: DataFrame, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """Ids of a few documents; decompresses only the frames they are in."""
    wanted, out = set(doc_ids), {}
    for m in manifest.toLocalIterator():
        reader = TokenFileReader(m["file"], m["item_bytes"])
        for k, doc in enumerate(reader.doc_ids):
            if doc in wanted:
                out[doc] = reader.tokens(k)
        reader.close()
    return out


END_ID = 1


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from textflow.llm.stage import documents
    manifest = write_token_files(
        documents(spark, sf_dir),
        public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return read_token_files(manifest, digest=True)
