"""Exact deduplication by Grace hash partitioning.

1. *Local tables.*  Every scan task keeps an open-addressing table of the
   complete normalised texts it has seen and gives each row the class of its
   text in that table.  A table that has grown to the memory budget hands
   its classes on and starts empty.  A text that holds a third of all rows
   therefore leaves each task as one class, not as its rows.
2. *Grace partitions.*  Class rows are written as spill files and dealt to
   partitions by a hash of the content.  The task of a partition puts them
   in an open-addressing table that compares complete contents.  When the
   table is full, contents that are not in it go to the spill files of the
   next level, which is partitioned anew with another seed; contents in the
   table stay complete, so every group is resolved by exactly one level.
3. Rows learn their group by a join on the class, whose rows are bounded by
   what one scan task saw before it handed its table on.

Normalisation lower-cases A-Z only; null text counts as empty.  Of equal
texts the row with the largest id stays (a null id is smaller than any;
of rows repeated with the same id one stays).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import partitions, written

MEMBER, CLASS, SPILL, MAPPED, KEPT = range(5)
TABLE_BYTES = 48 << 20
_BATCH_ROWS = 2048


class ContentTable:
    """Open addressing with linear probing; equal only if all bytes are."""

    def __init__(self) -> None:
        self._slots = np.full(1024, -1, np.int64)
        self._hash: list[int] = []
        self._content: list[bytes] = []
        self.nbytes = 0

    def __len__(self) -> int:
        return len(self._content)

    def _probe(self, h: int, content: bytes) -> tuple[int, int]:
        slots, mask = self._slots, len(self._slots) - 1
        i = h & mask
        while (e := slots[i]) >= 0:
            if self._hash[e] == h and self._content[e] == content:
                return i, int(e)
            i = (i + 1) & mask
        return i, -1

    def find(self, h: int, content: bytes) -> int:
        return self._probe(h, content)[1]

    def add(self, h: int, content: bytes) -> int:
        """Entry number of a content that is not in the table yet."""
        if 3 * len(self._content) >= 2 * len(self._slots):
            self._grow()
        at, _ = self._probe(h, content)
        n = len(self._content)
        self._slots[at] = n
        self._hash.append(h)
        self._content.append(content)
        self.nbytes += len(content) + 150
        return n

    def _grow(self) -> None:
        mask = 2 * len(self._slots) - 1
        slots = np.full(mask + 1, -1, np.int64)
        for e, h in enumerate(self._hash):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = e
        self._slots = slots


def content_key(text: bytes, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(text, seed=seed)


def normalised(rows: pa.StructArray, text: str) -> list[bytes]:
    col = rows.field(text).cast(pa.large_string()).fill_null("")
    return [t.lower() for t in col.cast(pa.large_binary()).to_pylist()]


class _Rows:
    """Chosen rows of many batches, by number."""

    def __init__(self) -> None:
        self._parts: list[pa.StructArray] = []
        self.count = 0
        self.nbytes = 0

    def take_from(self, rows: pa.StructArray, index: list[int]) -> None:
        if index:
            part = rows.take(pa.array(index, pa.int64()))
            self._parts.append(part)
            self.count += len(index)
            self.nbytes += part.nbytes

    def chosen(self, numbers: list[int]) -> Iterator[pa.StructArray]:
        """The numbered rows in order of their number, in slices."""
        base = np.cumsum([0] + [len(p) for p in self._parts])
        order = np.sort(np.asarray(numbers, np.int64))
        for part, lo in zip(self._parts, base, strict=False):
            mine = order[(order >= lo) & (order < lo + len(part))] - lo
            for i in range(0, len(mine), _BATCH_ROWS):
                yield part.take(pa.array(mine[i:i + _BATCH_ROWS]))


def _schema(row: T.StructType) -> T.StructType:
    return (T.StructType().add("kind", T.IntegerType())
            .add("class_id", T.LongType()).add("uid", T.LongType())
            .add("n", T.LongType()).add("hash", T.LongType())
            .add("sha256", T.StringType()).add("keep_uid", T.LongType())
            .add("keep", T.StructType().add("id", row.fields[0].dataType))
            .add("row", row.fields[1].dataType))


def _batch(like: pa.Schema, size: int, **cols) -> pa.RecordBatch:
    out = []
    for f in like:
        v = cols.get(f.name)
        if v is None:
            v = pa.nulls(size, f.type)
        elif not isinstance(v, pa.Array):
            v = pa.array(v, f.type)
        elif v.type != f.type:
            v = v.cast(f.type)
        out.append(v)
    return pa.RecordBatch.from_arrays(out, schema=like)


def _order(i) -> tuple:
    return (i is not None, i)


def _local(id_col: str, text_col: str, like: pa.Schema, budget: int,
           rows_out: bool):
    keep_type = like.field("keep").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        uid = classes = base
        table, rows = ContentTable(), _Rows()
        top: list = []          # per entry: [id, uid, row number, copies]

        def handed_on():
            nonlocal table, rows, top, classes
            by_row = sorted(range(len(top)), key=lambda e: top[e][2])
            at = 0
            for part in rows.chosen([t[2] for t in top]):
                es = by_row[at:at + len(part)]
                at += len(part)
                yield _batch(
                    like, len(es), kind=[CLASS] * len(es),
                    class_id=[classes + e for e in es],
                    uid=[top[e][1] for e in es], n=[top[e][3] for e in es],
                    hash=[content_key(table._content[e]) - (1 << 63)
                          for e in es],
                    sha256=[hashlib.sha256(table._content[e]).hexdigest()
                            for e in es], row=part)
            classes += len(top)
            table, rows, top = ContentTable(), _Rows(), []

        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH_ROWS):
                data = batch.column(0).slice(lo, _BATCH_ROWS)
                ids = data.field(id_col).to_pylist()
                entry, chosen = [], {}
                for i, t in enumerate(normalised(data, text_col)):
                    h = content_key(t)
                    e = table.find(h, t)
                    if e < 0:
                        e = table.add(h, t)
                        top.append([ids[i], uid + i, None, 0])
                        chosen[e] = i
                    elif _order(ids[i]) > _order(top[e][0]):
                        top[e][0], top[e][1] = ids[i], uid + i
                        chosen[e] = i
                    top[e][3] += 1
                    entry.append(e)
                for k, e in enumerate(chosen):
                    top[e][2] = rows.count + k
                rows.take_from(data, list(chosen.values()))
                if not rows_out:
                    yield _batch(
                        like, len(ids), kind=[MEMBER] * len(ids),
                        class_id=[classes + e for e in entry],
                        uid=list(range(uid, uid + len(ids))),
                        keep=pa.StructArray.from_arrays(
                            [data.field(id_col)], fields=list(keep_type)))
                uid += len(ids)
                if table.nbytes + rows.nbytes > budget:
                    yield from handed_on()
        yield from handed_on()

    return run


def _merge(id_col: str, text_col: str, like: pa.Schema, budget: int,
           seed: int, rows_out: bool):
    keep_type = like.field("keep").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rows = ContentTable(), _Rows()
        top: list = []      # per entry: [id, uid, row number, copies, sha]
        members: list[list[int]] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH_ROWS):
                b = batch.slice(lo, _BATCH_ROWS)
                col = {f.name: b.column(i) for i, f in enumerate(b.schema)}
                data = col["row"]
                ids = data.field(id_col).to_pylist()
                uids, ns = col["uid"].to_pylist(), col["n"].to_pylist()
                cls, shas = col["class_id"].to_pylist(), col["sha256"]
                chosen, spill = {}, []
                for i, t in enumerate(normalised(data, text_col)):
                    h = content_key(t, seed)
                    e = table.find(h, t)
                    if e < 0:
                        if table.nbytes + rows.nbytes > budget and len(table):
                            spill.append(i)
                            continue
                        e = table.add(h, t)
                        top.append([ids[i], uids[i], None, 0,
                                    shas[i].as_py()])
                        members.append([])
                        chosen[e] = i
                    elif (*_order(ids[i]), -uids[i]) > (*_order(top[e][0]),
                                                        -top[e][1]):
                        top[e][0], top[e][1] = ids[i], uids[i]
                        chosen[e] = i
                    top[e][3] += ns[i]
                    members[e].append(cls[i])
                for k, e in enumerate(chosen):
                    top[e][2] = rows.count + k
                rows.take_from(data, list(chosen.values()))
                if spill:
                    s = b.take(pa.array(spill, pa.int64()))
                    yield _batch(like, len(spill), kind=[SPILL] * len(spill),
                                 **{c: s.column(c) for c in (
                                     "class_id", "uid", "n", "hash",
                                     "sha256", "row")})
        if rows_out:
            for part in rows.chosen([t[2] for t in top]):
                yield _batch(like, len(part), kind=[KEPT] * len(part),
                             row=part)
            return
        flat = [(c, e) for e, m in enumerate(members) for c in m]
        for i in range(0, len(flat), 8 * _BATCH_ROWS):
            cs = flat[i:i + 8 * _BATCH_ROWS]
            yield _batch(
                like, len(cs), kind=[MAPPED] * len(cs),
                class_id=[c for c, _ in cs], n=[top[e][3] for _, e in cs],
                sha256=[top[e][4] for _, e in cs],
                keep_uid=[top[e][1] for _, e in cs],
                keep=pa.StructArray.from_arrays(
                    [pa.array([top[e][0] for _, e in cs],
                              keep_type.field(0).type)],
                    fields=list(keep_type)))

    return run


def _grace(docs: DataFrame, id_col: str, text_col: str, table_bytes: int,
           rows_out: bool) -> tuple[DataFrame, DataFrame]:
    """(the local stage's table, what the partitions of all levels gave)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns])
                         .alias("row"))
    schema = _schema(T.StructType().add("id", docs.schema[id_col].dataType)
                     .add("row", packed.schema["row"].dataType))
    like = to_arrow_schema(schema)
    first = written(packed.mapInArrow(
        _local(id_col, text_col, like, table_bytes, rows_out), schema),
        "dedup-local", "kind")
    todo = first.filter(F.col("kind") == CLASS)
    n, level, found = partitions(spark), 0, None
    while True:
        dealt = todo.repartitionById(n, F.pmod(F.xxhash64(
            "hash", F.lit(level)), F.lit(n)).cast("int"))
        out = written(dealt.mapInArrow(
            _merge(id_col, text_col, like, table_bytes, level + 1, rows_out),
            schema), f"dedup-level{level}", "kind")
        done = out.filter(F.col("kind").isin(MAPPED, KEPT))
        found = done if found is None else found.unionByName(done)
        todo = out.filter(F.col("kind") == SPILL)
        if todo.select("kind").isEmpty():
            return first, found
        level += 1


def assign_groups(docs: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", table_bytes: int = TABLE_BYTES
                  ) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of every row.

    ``table_bytes`` bounds the content table of one task.
    """
    first, found = _grace(docs.select(id_col, text_col), id_col, text_col,
                          table_bytes, False)
    groups = found.select("class_id", F.col("keep.id").alias("keep_id"),
                          F.col("n").alias("group_size"), "keep_uid",
                          F.col("sha256").alias("text_sha256"))
    members = first.filter(F.col("kind") == MEMBER).select(
        "class_id", "uid", F.col("keep.id").alias("id"))
    return members.join(groups, "class_id").select(
        "id", "keep_id", "group_size",
        (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", table_bytes: int = TABLE_BYTES
                ) -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``."""
    _, found = _grace(docs, id_col, text_col, table_bytes, True)
    return found.select("row.*")


def op1_grace_dedup(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    return assign_groups(documents(spark, sf_dir)).withColumnRenamed(
        "id", "doc_id")
