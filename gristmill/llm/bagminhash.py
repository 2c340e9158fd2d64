"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

Each shingle has a Poisson process of points over (time, weight), rate one: the
weight axis is cut into the dyadic blocks [0, 1), [1, 2), [2, 4), ..., each
with a process of its own whose points carry a discrete weight inside the block.
A shingle that occurs w times contributes the points under weight w, and every
point belongs to one of M components, at random. A component's signature is the
earliest point that any shingle contributes to it, so two texts agree in a
component with probability equal to the weighted Jaccard similarity. Points are
drawn in order of time, only until they are later than all components' earliest.

Signatures are banded; in each bucket all texts are first linked to one of them
(a different order of texts in each third of the bands picks which); links are
verified by exact weighted Jaccard, and classes are connected components.
Identical texts are collapsed beforehand, so no bucket sees a text twice.

Buckets whose texts are then all in one class are done: no other link in them
can matter. In the others, round after round, more of the texts (in hash order)
are heads, each of which is compared to the bucket's texts of other classes, in
blocks: by the share of signature components that agree, then exactly. A bucket
leaves when it is one class or when all its texts have been heads, so every pair
of a bucket is either tested or inside one class, however large the bucket is.

Defined cases: a null text is an empty one; texts without words are alike only
to identical texts, those of under five words have one shingle; rows that repeat
a doc_id are one node; a row with a null doc_id has a null class; an empty table
gives no rows. Extra columns are ignored, or pass through keep_one().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import components, cut, key128, salted_left_join, small_batches

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 5
M = BANDS * ROWS
ORDERS = 3
#: Heads of a bucket in the first round that looks at classes, and in each later one.
HEADS = (64, 1280)
#: Texts of a bucket that one task compares to the heads.
BLOCK = 512
#: Bytes of text, and distinct shingles, that a worker takes at once.
SLICE, AT_ONCE = 1 << 20, 1 << 16
#: Components of M that agree, at least, for a pair to be verified: 3.6 deviations under those of similarity 0.8.
AGREE = 51
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, shingle hash and count of each distinct (text, shingle) of a batch, in order."""
    buf, at = tokens.raw(batch.column(batch.schema.get_field_index("text")))
    words, of, _ = tokens.word_hashes(buf, at)
    n = np.diff(of)
    text = np.repeat(np.arange(len(n)), n)
    whole = tokens.shingles(words, SHINGLE)
    fits = np.flatnonzero(np.arange(len(whole)) + SHINGLE <= of[1:][text[: len(whole)]])
    t, h = text[fits], whole[fits]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        t = np.append(t, short)
        h = np.append(h, [tokens.shingles(words[of[i] : of[i + 1]], int(n[i]))[0] for i in short])
    order = np.lexsort((h, t))
    t, h = t[order], h[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return t[first], h[first], np.diff(np.append(first, len(t)))


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = M) -> np.ndarray:
    """The n x m matrix of earliest points; rows of texts without elements are infinite.

    text ascends; element is a 64-bit hash, weight a whole number of at least 1.
    Elements are drawn AT_ONCE at a time, so that a long text takes no more memory;
    what is known of a text's components already cuts the later ones short.
    """
    sig, limit = np.full(n * m, np.inf), np.full(n, np.inf)
    for lo in range(0, len(text), AT_ONCE):
        part = slice(lo, lo + AT_ONCE)
        _drawn(text[part], element[part], weight[part], sig, limit, m)
    return sig.reshape(n, m)


def _drawn(text: np.ndarray, element: np.ndarray, weight: np.ndarray, sig: np.ndarray, limit: np.ndarray, m: int) -> None:
    """Draw some elements' points into sig, and lower limit, the latest of a text's earliest points."""
    low = [np.zeros(len(text), np.int64)]
    of = [np.arange(len(text))]
    block = 1
    while len(over := np.flatnonzero(weight > block)):
        of.append(over)
        low.append(np.full(len(over), block))
        block *= 2
    of, low = np.concatenate(of), np.concatenate(low)
    t, w = text[of], weight[of]
    width = np.maximum(low, 1)
    with np.errstate(over="ignore"):
        seed = tokens.mix(element[of] + tokens.mix(low.astype(np.uint64) + _GOLD))
        time, step = np.zeros(len(of)), np.uint64(0)
        while len(t):
            step += np.uint64(1)
            a = tokens.mix(seed + step * _GOLD)
            b = tokens.mix(a ^ _GOLD)
            time = time - np.log(((a >> np.uint64(11)).astype(float) + 0.5) / 2**53) / width
            at = low + ((b >> np.uint64(32)).astype(float) / 2**32 * width).astype(np.int64)
            ok = (at < w) & (time < limit[t])
            np.minimum.at(sig, t[ok] * m + (b[ok] & np.uint64(0xFFFFFFFF)).astype(np.int64) % m, time[ok])
            here = np.unique(t)
            limit[here] = sig.reshape(-1, m)[here].max(1)
            on = time < limit[t]
            t, w, low, width, seed, time = t[on], w[on], low[on], width[on], seed[on], time[on]


def _signed(parts):
    for part in parts:
        for batch in tokens.batches(part, most=SLICE):
            t, h, w = bags(batch)
            sig = signatures(t, h, w, batch.num_rows)
            bits = sig.view(np.uint64).reshape(batch.num_rows, BANDS, ROWS)
            key = np.zeros(bits.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD
            for r in range(ROWS):
                key = tokens.mix(key ^ bits[:, :, r])
            empty = np.bincount(t, minlength=batch.num_rows) == 0
            offsets = np.append(0, np.cumsum(np.where(empty, 0, BANDS)))
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key[~empty].ravel().view(np.int64)))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([batch.column(names.index(c)) for c in ("doc_id", "k1", "k2")] + [bands], ["doc_id", "k1", "k2", "bands"])


def _bagged(parts):
    """doc_id, a 32-bit hash of each (shingle, occurrence): a multiset as a set, and a byte of each signature component."""
    for part in parts:
        for batch in tokens.batches(part, most=SLICE):
            t, h, w = bags(batch)
            nth = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            with np.errstate(over="ignore"):
                items = (tokens.mix(np.repeat(h, w) + nth.astype(np.uint64) * _GOLD) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            size = np.bincount(t, w, batch.num_rows).astype(np.int64)
            marks = (tokens.mix(signatures(t, h, w, batch.num_rows).view(np.uint64)) & np.uint64(255)).astype(np.uint8)
            bag = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(items))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), bag, pa.array([m.tobytes() for m in marks], pa.binary())], ["doc_id", "bag", "marks"])


def bagged(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, bag and marks of the texts of the documents in ids, each text once."""
    texts = docs.select("doc_id", "text").join(ids.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return cut(texts.mapInArrow(_bagged, "doc_id long, bag array<int>, marks binary"), "bags")


def star_links(rows: DataFrame) -> DataFrame:
    """(key, doc_id, turn) -> distinct (a, b): in each key's group, every document and one head."""
    order = F.xxhash64(F.col("turn"), F.col("doc_id"))
    heads = rows.groupBy("key").agg(F.count("*").alias("rows"), F.min_by("doc_id", F.struct(order, "doc_id")).alias("head")).where("rows > 1").select("key", "head")
    linked = salted_left_join(rows, heads, ["key"], ["doc_id"], hint="merge").where("head is not null and head <> doc_id")
    return linked.select(F.least("doc_id", "head").alias("a"), F.greatest("doc_id", "head").alias("b")).distinct()


def verified(docs: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is high enough, with it.

    The pairs grow with the corpus, so nothing here is broadcast, at any size.
    """
    held = bagged(docs, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
    one, two = held.select(F.col("doc_id").alias("a"), F.col("bag").alias("bag_a")), held.select(F.col("doc_id").alias("b"), F.col("bag").alias("bag_b"))
    both = F.size(F.array_intersect("bag_a", "bag_b"))
    alike = both / (F.size("bag_a") + F.size("bag_b") - both)
    return pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").select("a", "b", alike.alias("similarity")).where(F.col("similarity") >= similarity)


def _linked(similarity: float):
    """Of a bucket's heads and a block of its texts, links that join classes: enough to join all that the pairs join."""

    def links(heads: pa.Table, texts: pa.Table) -> pa.Table:
        def parts(t: pa.Table):
            marks = np.frombuffer(b"".join(t["marks"].to_pylist()), np.uint8).reshape(-1, M)
            bag = t["bag"].combine_chunks() if isinstance(t["bag"], pa.ChunkedArray) else t["bag"]
            return marks, bag.flatten().to_numpy(), np.append(0, np.cumsum(bag.value_lengths().to_numpy())).astype(np.int64), *(t[c].to_numpy() for c in ("doc_id", "root", "u"))

        (one, items_a, at_a, a, root_a, u_a), (two, items_b, at_b, b, root_b, u_b) = parts(heads), parts(texts)
        root_a, root_b = root_a.copy(), root_b.copy()
        found = []
        for i in range(len(a)):
            later = (u_b > u_a[i]) | ((u_b == u_a[i]) & (b > a[i]))
            near = np.flatnonzero(later & (root_b != root_a[i]))
            near = near[(two[near] == one[i]).sum(1) >= AGREE]
            if not len(near):
                continue
            own = np.sort(items_a[at_a[i] : at_a[i + 1]])
            size = at_b[near + 1] - at_b[near]
            index = np.arange(size.sum()) + np.repeat(at_b[near] - (np.cumsum(size) - size), size)
            item = items_b[index]
            shared = own[np.minimum(np.searchsorted(own, item), len(own) - 1)] == item
            both = np.bincount(np.repeat(np.arange(len(near)), size), shared, len(near))
            for j in near[both >= similarity * (len(own) + size - both)]:
                if root_b[j] != root_a[i]:
                    found.append((a[i], b[j]))
                    old, new = root_b[j], root_a[i]
                    root_a[root_a == old] = new
                    root_b[root_b == old] = new
        x, y = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": x, "b": y})

    return links


def settled(docs: DataFrame, texts: DataFrame, roots: DataFrame, similarity: float) -> DataFrame | None:
    """(id, root) that joins classes whose texts are linked by pairs that no head has met; None if there are none.

    texts has rep and bands of each distinct text, roots the classes so far.
    """
    own = texts.select(F.col("rep").alias("doc_id"), "bands").join(roots, F.col("doc_id") == F.col("id"), "left")
    rows = own.select("doc_id", F.coalesce("root", "doc_id").alias("root"), F.explode("bands").alias("key"))

    def mixed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")

    # pairs of two texts in a bucket have all met
    rows = salted_left_join(rows, mixed(rows).where("n > 2").select("key", "n"), ["key"], ["doc_id"], hint="merge").where("n is not null")
    u = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(2.0**53)
    first = cut(rows.withColumn("u", u), "mixed")
    rows, done, step, edges, joined = first, 0, 0, None, None
    held = None
    while rows.limit(1).count():
        if held is None:
            held = bagged(docs, first)
        more = done + HEADS[min(step, len(HEADS) - 1)]
        blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        full = rows.join(held.hint("merge"), "doc_id")
        heads = full.where((F.col("u") * F.col("n") >= done) & (F.col("u") * F.col("n") < more)).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        heads = heads.select(*[F.col(c).alias(c) for c in heads.columns])  # columns of its own: both sides come from rows
        dealt = full.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "doc_id"), blocks).cast("int"))
        links = heads.groupBy("key", "block").cogroup(dealt.groupBy("key", "block")).applyInArrow(_linked(similarity), "a long, b long").distinct()
        links = cut(links, "links")
        left, done, step = rows.where(F.col("n") > more), more, step + 1
        if links.limit(1).count():
            # links of texts are links of the classes that the texts had at first
            known = first.select("doc_id", "root").distinct()
            x, y = (known.select(F.col("doc_id").alias(k), F.col("root").alias(v)).hint("merge") for k, v in (("a", "x"), ("b", "y")))
            new = links.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
            edges = cut(new if edges is None else edges.union(new), "merged")
            joined = components(edges)
            now = joined.select(F.col("id").alias("root"), F.col("root").alias("to"))
            left = salted_left_join(first.where(F.col("n") > done), now, ["root"], ["doc_id", "key"], hint="merge").withColumn("root", F.coalesce("to", "root"))
            left = salted_left_join(left, mixed(left).select("key", F.lit(1).alias("open")), ["key"], ["doc_id"], hint="merge").where("open = 1")
        rows = cut(left.select(*first.columns), "mixed")
    return joined


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id, the smallest doc_id of its class, of every row of docs."""
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    signed = docs.select("doc_id", text.alias("text"), *key128(text)).mapInArrow(_signed, "doc_id long, k1 long, k2 long, bands array<long>")
    signed = cut(signed, "signatures")
    texts = signed.where("doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"))
    texts = cut(texts, "texts")
    rows = texts.select(F.col("rep").alias("doc_id"), F.posexplode("bands").alias("band", "key")).select("key", "doc_id", F.pmod("band", F.lit(ORDERS)).alias("turn"))
    links = cut(verified(docs, cut(star_links(rows), "pairs"), similarity), "links")
    roots = components(links)
    joined = settled(docs, texts, roots, similarity)
    reps = texts.select("k1", "k2", "rep").join(roots, F.col("rep") == F.col("id"), "left").select("k1", "k2", F.coalesce("root", "rep").alias("class_id"))
    if joined is not None:
        reps = salted_left_join(reps, joined.select(F.col("id").alias("class_id"), F.col("root").alias("to")), ["class_id"], ["k1"], hint="merge").select("k1", "k2", F.coalesce("to", "class_id").alias("class_id"))
    out = salted_left_join(signed.select("doc_id", "k1", "k2"), reps, ["k1", "k2"], ["doc_id"], hint="merge")
    return out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with the document of the smallest id of each class only; repeats of its row go too."""
    stay = classes(docs, similarity).where("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.select(*docs.columns).union(docs.where("doc_id is null"))
