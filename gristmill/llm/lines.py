"""Line dedup whose index can grow, shrink and be undone.

The index of a corpus is made of tables in the shared folder:

- holders (k1, k2, doc_id): which documents hold a key, once each;
- refs (k1, k2, n, keeper): each key's exact count of documents and the largest
  of them. Documents that come in add to it; for those that go, the keys they
  held are counted anew, so lines come back when a key falls below the limit;
- filters (shard, mask, cells, held): a small cuckoo filter for each shard of
  the keys that are over the limit. It supports insertion and deletion, doubles
  when it is full, so that no key is ever turned away, and lets most lines of a
  corpus skip the exact look-up. It is looked into by a join and SQL functions.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case. Keys of at least MIN_CHARS code points in at least MIN_DOCS documents
lose all their lines except in the largest doc_id that holds them.

Defined cases: a null or empty text is one empty line and loses none; rows that
repeat a doc_id are one document to the counts, and each is rewritten; rows with
a null doc_id are never counted and never rewritten; an empty table gives no
rows. Other columns of docs pass through drop_lines(), whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, key128, salted_left_join

MIN_CHARS, MIN_DOCS = 40, 5
SPACE = " \t\n\x0b\x0c\r"
KEYS_PER_SHARD, SLOTS, KICKS, STEP = 64, 4, 100, 0x5BD1E995
FILTER = "shard int, mask int, cells array<int>, held array<long>"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class Cuckoo:
    """A cuckoo filter of 16-bit marks, four to a bucket, with the keys that it holds."""

    def __init__(self, keys=()):
        self.held: dict[int, None] = {}
        self._build(2, [int(k) for k in keys])

    @staticmethod
    def mark(key: int) -> int:
        return ((key >> 40) & 0xFFFF) | 1

    def other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * STEP)) & self.mask

    def _build(self, buckets: int, keys: list[int]) -> None:
        while buckets * SLOTS * 0.9 < len(keys):
            buckets *= 2
        while True:
            self.mask, self.cells = buckets - 1, [0] * (buckets * SLOTS)
            if all(self._place(k) for k in keys):
                self.held = dict.fromkeys(keys)
                return
            buckets *= 2

    def _free(self, bucket: int, mark: int) -> bool:
        for i in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.cells[i]:
                self.cells[i] = mark
                return True
        return False

    def _place(self, key: int) -> bool:
        mark, bucket = self.mark(key), key & self.mask
        if self._free(bucket, mark) or self._free(b := self.other(bucket, mark), mark):
            return True
        for kick in range(KICKS):
            i = b * SLOTS + kick % SLOTS
            mark, self.cells[i] = self.cells[i], mark
            b = self.other(b, mark)
            if self._free(b, mark):
                return True
        return False

    def insert(self, key: int) -> None:
        """Add a key; a full table is built again at twice the size."""
        if key in self.held:
            return
        before = list(self.cells)
        if self._place(key):
            self.held[key] = None
        else:
            self.cells = before
            self._build((self.mask + 1) * 2, [*self.held, key])

    def delete(self, key: int) -> None:
        """Take a key away, if it is held."""
        if key not in self.held:
            return
        del self.held[key]
        mark, bucket = self.mark(key), key & self.mask
        for b in (bucket, self.other(bucket, mark)):
            for i in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.cells[i] == mark:
                    self.cells[i] = 0
                    return

    def __contains__(self, key: int) -> bool:
        mark, bucket = self.mark(key), key & self.mask
        return any(mark in self.cells[b * SLOTS : b * SLOTS + SLOTS] for b in (bucket, self.other(bucket, mark)))


def _may_hold(k1: Column, mask: Column, cells: Column) -> Column:
    """Cuckoo.__contains__ in SQL functions."""
    mark = F.shiftright(k1, 40).bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.lit(1))
    bucket = k1.bitwiseAND(mask.cast("long"))
    other = bucket.bitwiseXOR(mark * F.lit(STEP)).bitwiseAND(mask.cast("long"))
    found = [F.array_contains(F.slice(cells, (b * SLOTS + 1).cast("int"), F.lit(SLOTS)), mark.cast("int")) for b in (bucket, other)]
    return F.coalesce(found[0] | found[1], F.lit(False))


def _shard(k1: Column, shards: int) -> Column:
    return F.pmod(F.shiftright(k1, 20), F.lit(shards)).cast("int")


def _changed(key, filters, changes):
    """One shard's filter after keys came over the limit or fell below it."""
    own = Cuckoo()
    if len(filters):
        own.mask, own.cells, held = (filters[c][0].as_py() for c in ("mask", "cells", "held"))
        own.held = dict.fromkeys(held)
    for k, over in sorted(zip(changes["k1"].to_pylist(), changes["over"].to_pylist(), strict=True)):
        own.insert(k) if over else own.delete(k)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "mask": pa.array([own.mask], pa.int32()), "cells": pa.array([own.cells], pa.list_(pa.int32())), "held": pa.array([list(own.held)], pa.list_(pa.int64()))})


def _built(key, table):
    none = pa.table({"mask": pa.array([], pa.int32())})
    changes = pa.table({"k1": table["k1"], "over": pa.array([True] * len(table))})
    return _changed(key, none, changes)


def holders_of(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id) once for each long enough key and document."""
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col("text")), line_key), lambda k: F.length(k) >= MIN_CHARS))
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.explode(keys).alias("key"))
    return rows.select(*key128(F.col("key")), "doc_id").distinct()


def _refs(holders: DataFrame) -> DataFrame:
    return holders.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))


@dataclass
class LineIndex:
    holders: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int

    @staticmethod
    def build(docs: DataFrame) -> LineIndex:
        holders = cut(holders_of(docs), "holders")
        return LineIndex._filtered(holders, cut(_refs(holders), "refs"))

    @staticmethod
    def _filtered(holders: DataFrame, refs: DataFrame) -> LineIndex:
        """The index with filters of about KEYS_PER_SHARD keys each."""
        over = refs.where(F.col("n") >= MIN_DOCS)
        shards = max(1, -(-over.count() // KEYS_PER_SHARD))
        filters = over.select(_shard(F.col("k1"), shards).alias("shard"), "k1").groupBy("shard").applyInArrow(_built, FILTER)
        return LineIndex(holders, refs, cut(filters, "filters"), shards)

    def _with(self, holders: DataFrame, refs: DataFrame) -> LineIndex:
        """The index with other tables; filters change only where keys cross the limit.

        Where they have come to hold twice as many keys, they are dealt anew to more shards.
        """
        if refs.where(F.col("n") >= MIN_DOCS).count() > 2 * KEYS_PER_SHARD * self.shards:
            return LineIndex._filtered(holders, refs)
        was, now = (r.where(F.col("n") >= MIN_DOCS).select("k1", "k2") for r in (self.refs, refs))
        up = now.join(was, ["k1", "k2"], "left_anti").select("k1", F.lit(True).alias("over"))
        down = was.join(now, ["k1", "k2"], "left_anti").select("k1", F.lit(False).alias("over"))
        changes = up.union(down).withColumn("shard", _shard(F.col("k1"), self.shards))
        filters = self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(_changed, FILTER)
        return LineIndex(holders, refs, cut(filters, "filters"), self.shards)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index after documents come in."""
        new = cut(holders_of(docs).join(self.holders, ["k1", "k2", "doc_id"], "left_anti"), "new")
        refs = self.refs.union(_refs(new)).groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"))
        return self._with(cut(self.holders.union(new), "holders"), cut(refs, "refs"))

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index after documents (a column doc_id) go: as if they had never come."""
        ids = doc_ids.select("doc_id").distinct()
        holders = cut(self.holders.join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id"), "holders")
        touched = cut(self.holders.join(ids, "doc_id", "left_semi").select("k1", "k2").distinct(), "touched")
        again = _refs(salted_left_join(holders, touched.withColumn("hit", F.lit(1)), ["k1", "k2"], ["doc_id"]).where("hit = 1"))
        return self._with(holders, cut(self.refs.join(touched, ["k1", "k2"], "left_anti").union(again), "refs"))

    def losers(self) -> DataFrame:
        """doc_id and __keys, hashes of the keys whose lines it loses, for documents that lose some."""
        rows = self.holders.withColumn("shard", _shard(F.col("k1"), self.shards))
        maybe = salted_left_join(rows, self.filters.drop("held"), ["shard"], ["doc_id", "k2"]).where(_may_hold(F.col("k1"), F.col("mask"), F.col("cells")))
        over = self.refs.where(F.col("n") >= MIN_DOCS)
        exact = salted_left_join(maybe.select("k1", "k2", "doc_id"), over, ["k1", "k2"], ["doc_id"]).where("doc_id < keeper")
        return exact.groupBy("doc_id").agg(F.collect_list(F.col("k1").bitwiseXOR(F.col("k2"))).alias("__keys"))


@F.arrow_udf(T.ArrayType(T.BooleanType()))
def _among(lines: pa.Array, keys: pa.Array) -> pa.Array:
    """Which of a text's lines (hashes; null: too short) are among its keys: one sorted look-up for each text."""
    out = [None if k.as_py() is None else np.isin(np.asarray(x.values.fill_null(0)), np.asarray(k.values)) & np.asarray(x.values.is_valid()) for x, k in zip(lines, keys, strict=True)]
    return pa.array(out, pa.list_(pa.bool_()))


def drop_lines(docs: DataFrame, index: LineIndex | None = None) -> DataFrame:
    """docs with text rewritten, and __n_lines and __n_dropped, of each row."""
    losers = (index or LineIndex.build(docs)).losers().withColumn("__z", F.lit(0))
    lines, loses = split_lines(F.col("text")), F.col("__keys").isNotNull()
    # rows without a doc_id meet no loser: they are dealt out evenly
    rows = docs.withColumn("__z", F.when(F.col("doc_id").isNull(), F.hash("text")).otherwise(0))
    out = rows.join(losers, ["doc_id", "__z"], "left")
    hashed = F.transform(lines, lambda line: F.when(F.length(line_key(line)) >= MIN_CHARS, F.xxhash64(line_key(line)).bitwiseXOR(F.xxhash64(F.lit("b"), line_key(line)))))
    out = out.withColumn("__gone", _among(F.when(loses, hashed), F.col("__keys")))
    out = out.withColumn("__kept", F.when(loses, F.filter(lines, lambda line, i: ~F.get("__gone", i)))).withColumn("__n_lines", F.size(lines).cast("long"))
    dropped = F.when(loses, F.col("__n_lines") - F.size("__kept")).otherwise(F.lit(0)).cast("long").alias("__n_dropped")
    text = F.when(loses, F.array_join("__kept", "\n")).otherwise(F.col("text"))
    return out.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns], "__n_lines", dropped)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the text that stays."""
    out = drop_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
