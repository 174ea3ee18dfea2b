"""Exact deduplication with cuckoo-filter indexes.

Texts are equal when identical after deleting white space (space and U+0009 to U+000D); the
SHA-256 of what is left is the key. An index holds 16-bit fingerprints in buckets of four and, beside
each, the whole key: a fingerprint hit counts only if the keys agree, a full table is rebuilt at
twice the size from the stored keys, and keys can be deleted.

``deduplicate`` builds an index per scan task first, so a group of copies of any size leaves a
task as one row, then one per shard of keys. Of equal texts the row with the most code
points stays, then the smallest doc_id (null last), then the first of repeated rows. Null and empty
texts are equal to each other. Extra columns are kept out of the work. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneloom.llm.common import numbered, text_of

SLOTS = 4
FLUSH_KEYS = 200_000  # a scan task passes on what it has beyond so many distinct keys
_MOVES = 200


class CuckooIndex:
    """Live keys (bytes of 16 or more, evenly spread) with a payload each."""

    def __init__(self, buckets: int = 256):
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (buckets * SLOTS)
        self.values: list = [None] * (buckets * SLOTS)
        self.size = 0

    def _place(self, key: bytes) -> tuple[int, int]:
        mark = int.from_bytes(key[:2], "little") or 1
        return mark, int.from_bytes(key[2:10], "little") & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _slot(self, key: bytes) -> int:
        mark, bucket = self._place(key)
        for b in (bucket, self._other(bucket, mark)):
            for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.keys[slot] == key:
                    return slot
        return -1

    def __len__(self) -> int:
        return self.size

    def __contains__(self, key: bytes) -> bool:
        return self._slot(key) >= 0

    def get(self, key: bytes):
        slot = self._slot(key)
        return self.values[slot] if slot >= 0 else None

    def put(self, key: bytes, value) -> bool:
        """Insert the key or replace its payload; true if it is new."""
        slot = self._slot(key)
        if slot >= 0:
            self.values[slot] = value
            return False
        while (left := self._insert(key, value)) is not None:
            self._resize(left)
            key, value = left
            if key in self:
                break
        return True

    def _insert(self, key: bytes, value) -> tuple[bytes, object] | None:
        """None, or the entry that found no slot."""
        mark, bucket = self._place(key)
        turn = 0
        for move in range(_MOVES):
            for b in (bucket, self._other(bucket, mark)):
                for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                    if self.keys[slot] is None:
                        self.prints[slot], self.keys[slot], self.values[slot] = mark, key, value
                        self.size += 1
                        return None
            bucket = self._other(bucket, mark) if move & 1 else bucket
            slot = bucket * SLOTS + turn
            turn = (turn + 1) % SLOTS
            out = self.keys[slot], self.values[slot]
            self.prints[slot], self.keys[slot], self.values[slot] = mark, key, value
            key, value = out
            mark = self._place(key)[0]
            bucket = self._other(bucket, mark)
        return key, value

    def _resize(self, homeless: tuple[bytes, object]) -> None:
        stored = [*self.items(), homeless]
        buckets = 2 * (self.mask + 1)
        while True:
            self._empty(buckets)
            if all(self._insert(k, v) is None for k, v in stored):
                return
            buckets *= 2

    def delete(self, key: bytes) -> bool:
        slot = self._slot(key)
        if slot < 0:
            return False
        self.prints[slot], self.keys[slot], self.values[slot] = 0, None, None
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


_GROUPS = "digest binary, members long, length long, id long, row_key long"


def _merge(batches: Iterator[pa.RecordBatch], flush: int | None) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()

    def out() -> pa.RecordBatch:
        found = list(index.items())
        columns = [[k for k, _ in found], *([v[i] for _, v in found] for i in range(4))]
        kinds = [pa.binary(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=["digest", "members", "length", "id", "row_key"],
        )

    for batch in batches:
        for key, n, *own in zip(*(batch.column(i).to_pylist() for i in range(5))):
            held = index.get(key)
            if held is None:
                index.put(key, (n, *own))
            else:
                index.put(key, (held[0] + n, *min(held[1:], tuple(own), key=_preference)))
        if flush and len(index) >= flush:
            yield out()
            index = CuckooIndex()
    yield out()


def _preference(row: tuple) -> tuple:
    length, doc, row_key = row
    return -length, doc is None, doc or 0, row_key


def _merge_scan(batches):
    return _merge(batches, FLUSH_KEYS)


def _merge_shard(batches):
    return _merge(batches, None)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows repeated with the same id stay apart: exactly one row of a group has ``kept``.
    """
    text = text_of(text_col)
    rows = numbered(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            F.char_length(text).cast("long").alias("length"),
            F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
        )
    )
    groups = (
        rows.select("digest", F.lit(1).cast("long").alias("members"), "length", "id", "row_key")
        .mapInArrow(_merge_scan, _GROUPS)
        .repartition("digest")
        .mapInArrow(_merge_shard, _GROUPS)
        .select(
            "digest",
            F.col("members").alias("group_size"),
            F.col("id").alias("keep_id"),
            F.col("row_key").alias("keep_row"),
        )
    )
    return rows.join(groups, "digest").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("row_key") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for batch in batches:
        for key, insert in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if insert:
                index.put(key, None)
            else:
                index.delete(key)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in index.items()], pa.binary())], names=["digest"]
    )


def apply_changes(live: DataFrame, changes: DataFrame) -> DataFrame:
    """Live digests after insertions and deletions.

    ``live``: digest. ``changes``: digest, seq (their order), insert (boolean). Only the last change of
    a digest counts, found by a mergeable aggregate, so a digest changed very often is one row. Null
    digests are left out; deleting an unknown digest does nothing.
    """
    last = changes.groupBy("digest").agg(F.max_by("insert", "seq").alias("insert"))
    held = live.select("digest").distinct()
    return (
        held.select("digest", F.lit(True).alias("insert"), F.lit(0).alias("step"))
        .union(last.select("digest", "insert", F.lit(1)))
        .where("digest is not null and insert is not null")
        .repartition("digest")
        .sortWithinPartitions("step")
        .select("digest", "insert")
        .mapInArrow(_apply, "digest binary")
    )
