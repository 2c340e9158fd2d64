"""Near-duplicate passages by compact windows.

A text is the sequence of its five-word shingles, and a passage is a run of
LENGTH of them (LENGTH + 4 words); longer repeats are unions of passages. For each
of a few hash functions a Cartesian tree over the text's shingle hashes gives
compact windows (l, c, r): all passages inside [l, r] that hold c have their
min-hash there. Windows under LENGTH are never opened. For a band of two hash
functions the windows' overlaps, an interval join inside the text, are cells of
passages that share both min-hashes. Cells of all texts are grouped by signature
over BANDS bands.

In a group every cell is first linked to one cell of another document, never to all.
Each map task links the cells that it holds itself and sends on those of one
document of each signature, so that however common a passage is, a key has few
rows of each map task. The cells that it doesn't send are dealt out evenly, for the
groups below.

A link says how two texts lie against each other: their cells hold the same shingle
at their min-hash. Links are gathered by pair of documents and offset, and verified
passage against passage (equal cells of one document count once; at the end all passages equal
to a repeat's are repeats, too): two passages at that offset (or up to DRIFT shingles beside
it, for words left out or put in) repeat each other if they share SHARED of their
LENGTH shingles in place, a Jaccard similarity of at least 0.8.

A group of which each document has a repeat in its cell, and all are in one class,
is done. In the others all cells of different classes are compared: those of groups
of up to FEW unlike cells are verified as above at once, many groups together; those of
others first meet, in blocks of SIDE cells, in matrix products that count shared
shingles, and those that share enough are verified. A group of more than SIDE cells first meets HEADS[0] of them.
If it stays open, it is split: two passages that share SHARED of LENGTH
shingles share one of the first LENGTH - SHARED + 1 of both in any fixed order.
With shingles that the heads don't hold first, this keeps apart whatever only a
common line brought together. The parts meet HEADS[1] of their cells, round after round, until
each is one class or all pairs of different classes were compared.

Defined cases: null, empty and short texts have no passages; repeated rows of one
doc_id are one document (of its texts the longest is compared), and repeats inside
one document don't count; rows with a null doc_id are left out; an empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import tokens
from .common import components, cut, salted_left_join, small_batches

SHINGLE, LENGTH, SIMILARITY = 5, 46, 0.8
BANDS = 4
#: Cells that a map task combines at once.
MAX_CELLS = 2_000_000
#: Cells of a group that are compared with each other at once, and those that a larger group meets before it is split.
SIDE, HEADS = 4096, (64, 4096)
#: Rows of groups that are read at once, cells of groups all of whose pairs are compared at once, and shingles of pairs that are.
ROWS, FEW, TOGETHER = 2048, 32, 1 << 16
#: Shingles by which a passage may be shifted inside a repeat.
DRIFT = 5
#: Shingles of LENGTH that two passages share at a Jaccard similarity of SIMILARITY.
SHARED = int(np.ceil(2 * LENGTH * SIMILARITY / (1 + SIMILARITY)))
_SALT = tokens.mix(np.arange(1, 2 * BANDS + 1, dtype=np.uint64))
#: Bits of a place in a batch of shingles.
_PLACE = np.uint64((1 << 28) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
#: Kinds of rows that a map task sends: cells of a key's first document, links inside the task, all other cells.
FIRST, LINK, REST = 0, 1, 2
SENT = "key long, kind int, doc_id long, lo int, hi int, mid int, other long"
FOUND = "doc_id long, partner_id long, start_word int, end_word int, similarity double"
NAMES = ["doc_id", "partner_id", "start_word", "end_word", "similarity"]


def minima(v: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """The places in v[start:end] of each sequence that hold the first minimum of some run of `least` values.

    Values are ordered by their upper bits and then by place, so that no two are equal.
    """
    if len(v) < least:
        return np.zeros(0, np.int64)
    low, width = (v & ~_PLACE) | np.arange(len(v), dtype=np.uint64), 1
    while 2 * width <= least:  # minima of runs of 1, 2, 4, ... values, and at last of two runs that overlap
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    low = np.minimum(low[: len(low) - (least - width)], low[least - width :])
    inside = np.zeros(len(v) + 1, np.int64)
    wide = ends - starts >= least
    np.add.at(inside, starts[wide], 1)
    np.add.at(inside, ends[wide] - least + 1, -1)
    at = (low[np.cumsum(inside)[: len(low)] > 0] & _PLACE).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    return at[new]


def _smaller(value: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The nearest smaller value's place on one side, from the neighbours' places on that side (-1 for none).

    All between a place and its candidate are greater than it, so a candidate that is
    greater, too, hands on its own; those still looking become few quickly.
    """
    value = np.append(value, np.uint64(0))  # at -1
    looking = np.flatnonzero(value[near] > value[:-1])
    while len(looking):
        near[looking] = near[near[looking]]
        looking = looking[value[near[looking]] > value[looking]]
    return near


def compact_windows(v: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of all compact windows of at least that width in v[start:end] of each sequence.

    These are the upper nodes of the sequences' Cartesian trees: a node's window is
    wide enough if and only if it is the first minimum of some run of `least`
    values, and so are then all nodes above it. The trees of those places alone are
    grown, all nodes at once: a node's window ends before the nearest smaller on each side.
    """
    at = minima(v, starts, ends, least)
    value = (v[at] & ~_PLACE) | at.astype(np.uint64)
    wide = ends - starts >= least
    starts, ends = starts[wide], ends[wide]
    s, e = np.searchsorted(at, starts), np.searchsorted(at, ends)
    before, after = np.arange(-1, len(at) - 1), np.arange(1, len(at) + 1)
    before[s], after[e - 1] = -1, -1
    before, after = _smaller(value, before), _smaller(value, after)
    of = np.repeat(np.arange(len(starts)), e - s)
    return np.where(before < 0, starts[of], at[before] + 1), at, np.where(after < 0, ends[of], at[after]) - 1


def _shingled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All shingle hashes of a batch, and where those of each text start and end."""
    buf, at = tokens.raw(batch.column(batch.schema.get_field_index("text")))
    words, of, _ = tokens.word_hashes(buf, at)
    return tokens.shingles(words, SHINGLE), of[:-1], np.maximum(of[1:] - SHINGLE + 1, of[:-1])


def cells(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Signature, first and last passage, and place of the first function's min-hash, of each cell of all bands."""
    found = []
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            tiles = []
            for j in (2 * band, 2 * band + 1):
                v = tokens.mix(h ^ _SALT[j])
                lo, c, hi = compact_windows(v, starts, ends)
                tiles.append((np.maximum(lo, c - LENGTH + 1), v[c], c))  # in order of place
            (p, a, c), (q, b, _) = tiles
            at = np.union1d(p, q)
            if not len(at):
                continue
            own = np.searchsorted(p, at, "right") - 1
            both = a[own] * _SALT[0] + b[np.searchsorted(q, at, "right") - 1]
            # a cell ends where the next one of its text starts, or at the text's last passage
            last = np.minimum(np.append(at[1:], at[-1] + len(h)) - 1, ends[np.searchsorted(starts, at, "right") - 1] - LENGTH)
            found.append((tokens.mix(both + _SALT[band]), at, last, c[own]))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def contents(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the shingles of each cell, wherever it lies."""
    with np.errstate(over="ignore"):
        up, down = (np.cumprod(np.full(len(h) + 1, x, np.uint64)) for x in (_BASE, _BACK))
        total = np.append(np.uint64(0), np.cumsum(h * up[: len(h)]))
        size = (last - first + LENGTH).astype(np.uint64)
        return tokens.mix((total[last + LENGTH] - total[first]) * down[first] + size)


def _combined(key: np.ndarray, doc: np.ndarray, place: np.ndarray, last: np.ndarray, mid: np.ndarray, content: np.ndarray) -> pa.RecordBatch:
    """The cells of one document of each key, to be sent on; links of cells to another document's; all other cells.

    Of equal cells of a document only the first counts.
    """
    # most keys have one cell here; those of the others alone are ordered further
    order = np.argsort(key)
    new = np.ones(len(key) + 1, bool)
    new[1:-1] = key[order][1:] != key[order][:-1]
    alone, order = order[new[:-1] & new[1:]], order[~(new[:-1] & new[1:])]
    single = [x[alone] for x in (key, doc, place, last, mid)]
    order = order[np.lexsort((place[order], content[order], doc[order], key[order]))]
    again = np.zeros(len(order), bool)
    again[1:] = (key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1]) & (content[order][1:] == content[order][:-1])
    order = order[~again]
    key, doc, place, last, mid = (x[order] for x in (key, doc, place, last, mid))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(key)))
    first = np.repeat(at, size)
    far = doc != doc[first]
    # the first cell of another document, if there is one, for the further cells of the first document
    after = np.minimum.reduceat(np.where(far, np.arange(len(key)), len(key)), at) if len(at) else at
    after = np.repeat(after, size)
    met = np.where(far, first, after)
    x = np.flatnonzero(met < len(key))
    a, b, lo, hi, shift = _turned(doc[x], doc[met[x]], place[x], last[x], mid[x] - mid[met[x]])
    by = np.lexsort((shift, b, a))
    a, b, lo, hi, shift = (y[by] for y in (a, b, lo, hi, shift))
    edge = np.ones(len(a), bool)
    edge[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (shift[1:] != shift[:-1])
    g = np.flatnonzero(edge)
    lo, hi = (np.minimum.reduceat(lo, g), np.maximum.reduceat(hi, g)) if len(g) else (lo, hi)
    a, b, shift = a[g], b[g], shift[g]
    one = new.copy()
    one[1:] |= doc[1:] != doc[:-1]
    held = np.where(new, np.repeat(np.add.reduceat(one, at), size) if len(at) else 0, 0)[~far]
    with np.errstate(over="ignore"):  # links and other cells are dealt out evenly
        dealt = [tokens.mix(tokens.mix(u.astype(np.uint64)) + w.astype(np.uint64)) for u, w in ((a, b), (doc[far], key[far]))]
    key_one, doc_one, place_one, last_one, mid_one = single
    part = lambda *x: pa.array(np.concatenate(x))
    columns = [
        part(key_one.view(np.int64), key[~far].view(np.int64), dealt[0].view(np.int64), dealt[1].view(np.int64)),
        pa.array(np.repeat(np.array([FIRST, LINK, REST], np.int32), [len(alone) + int((~far).sum()), len(a), int(far.sum())])),
        part(doc_one, doc[~far], a, doc[far]),
        *(part(x, y[~far], z, y[far]).cast(pa.int32()) for x, y, z in ((place_one, place, lo), (last_one, last, hi), (mid_one, mid, shift))),
        part(np.ones(len(alone), np.int64), held.astype(np.int64), b, key[far].view(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["key", "kind", "doc_id", "lo", "hi", "mid", "other"])


def _turned(a, b, lo, hi, shift):
    """A link with the smaller document first: passages lo .. hi of a lie at lo - shift .. hi - shift of b."""
    turn = a > b
    return np.where(turn, b, a), np.where(turn, a, b), np.where(turn, lo - shift, lo), np.where(turn, hi - shift, hi), np.where(turn, -shift, shift)


def _celled(parts):
    waiting, n = [], 0
    for part in parts:
        for batch in tokens.batches(part, most=1 << 20):
            h, starts, ends = _shingled(batch)
            key, at, last, mid = cells(h, starts, ends)
            of = np.searchsorted(starts, at, "right") - 1
            doc = batch.column(batch.schema.get_field_index("doc_id")).to_numpy()
            waiting.append((key, doc[of], *((x - starts[of]).astype(np.int32) for x in (at, last, mid)), contents(h, at, last)))
            n += len(key)
            if n >= MAX_CELLS:
                yield _combined(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                waiting, n = [], 0
    if n:
        yield _combined(*(np.concatenate(x) for x in zip(*waiting, strict=True)))


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, shift, lo, hi) of documents to verify, a < b, and the cells (key, doc_id, lo, hi, mid) of groups of three or more."""
    rows = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(_celled, SENT)
    group = W.Window.partitionBy("key")
    cell = F.struct("doc_id", "lo", "mid")
    rows = rows.withColumn("__one", F.min(F.when(F.col("kind") == FIRST, cell)).over(group)).withColumn("__n", F.sum(F.when(F.col("kind") == FIRST, F.col("other"))).over(group))
    rows = rows.where(f"kind <> {FIRST} or __n > 1")
    rows = rows.withColumn("__two", F.min(F.when((F.col("kind") == FIRST) & (F.col("doc_id") != F.col("__one.doc_id")), cell)).over(group))
    met = F.when(F.col("kind") == FIRST, F.when(F.col("doc_id") == F.col("__one.doc_id"), F.col("__two")).otherwise(F.col("__one")))
    rows = cut(rows.withColumn("__met", met).select("key", "kind", "doc_id", "lo", "hi", "mid", "other", F.col("__n").alias("n"), F.col("__met.doc_id").alias("b"), (F.col("mid") - F.col("__met.mid")).alias("shift")), "cells")
    far = rows.where("b is not null")
    turn = F.col("doc_id") > F.col("b")
    either = lambda x, y: F.when(turn, x).otherwise(y)
    far = far.select(either(F.col("b"), F.col("doc_id")).alias("a"), either(F.col("doc_id"), F.col("b")).alias("b"), either(-F.col("shift"), F.col("shift")).alias("shift"), *[either(F.col(c) - F.col("shift"), F.col(c)).alias(c) for c in ("lo", "hi")])
    own = rows.where(f"kind = {LINK}").select(F.col("doc_id").alias("a"), F.col("other").alias("b"), F.col("mid").alias("shift"), "lo", "hi")
    pairs = own.union(far).groupBy("a", "b", "shift").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    many = rows.where(f"kind = {FIRST} and n > 2").select("key", "doc_id", "lo", "hi", "mid")
    rest = rows.where(f"kind = {REST}").select(F.col("other").alias("key"), "doc_id", "lo", "hi", "mid")
    rest = salted_left_join(rest, many.groupBy("key").agg(F.lit(1).alias("many")), ["key"], ["doc_id", "lo"], hint="merge").where("many = 1")
    return pairs, many.union(rest.select(*many.columns))


def _arrays(parts):
    for part in parts:
        for batch in tokens.batches(part, most=1 << 20):
            h, starts, ends = _shingled(batch)
            size = ends - starts
            index = np.arange(size.sum()) + np.repeat(starts - (np.cumsum(size) - size), size)
            items = (h[index] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(items))], ["doc_id", "sh"])


def _laid(x, x_at, n, y, y_at, m, at):
    """Parts of x, DRIFT free places around each, and beside them what of y lies there; the part of each place."""
    size = n + 2 * DRIFT
    of = np.repeat(np.arange(len(n)), size)
    place = np.arange(len(of)) - (np.cumsum(size) - size)[of] - DRIFT
    one, two = np.full(len(of), 1 << 41), np.full(len(of), 1 << 40)
    here = np.flatnonzero((place >= 0) & (place < n[of]))
    one[here] = x[x_at[of[here]] + place[here]]
    place += at[of]
    here = np.flatnonzero((place >= 0) & (place < m[of]))
    two[here] = y[y_at[of[here]] + place[here]]
    return one, two, of


def _beside(one: np.ndarray, two: np.ndarray):
    """For each drift, the places of one whose shingle lies that far beside them in two."""
    two = np.concatenate([np.full(DRIFT, 1 << 40), two, np.full(DRIFT, 1 << 40)])
    return (one == two[DRIFT + e : DRIFT + e + len(one)] for e in range(-DRIFT, DRIFT + 1))


def _sums(flags: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=total[1:])
    return total


def _alike(x, x_at, n, y, y_at, m, at) -> tuple[np.ndarray, ...]:
    """alike for some pairs, all of LENGTH shingles at least, at once."""
    one, two, of = _laid(x, x_at, n, y, y_at, m, at)
    start = np.cumsum(n + 2 * DRIFT) - n - DRIFT
    equal = _sums(one == two)
    equal = equal[start + n] - equal[start] == n
    e = np.repeat(np.flatnonzero(equal), n[equal] - LENGTH + 1)
    p = np.arange(len(e)) - np.searchsorted(e, e)
    found = [(e, p, p + at[e], np.full(len(e), LENGTH))]
    # passages of the others that have enough of their shingles in y
    any_x = np.logical_or.reduce(list(_beside(one, two)))
    of_x = _sums(any_x)
    i = np.flatnonzero(of_x[LENGTH:] - of_x[:-LENGTH] >= SHARED)
    k = of[i]
    i = i[~equal[k] & (i >= start[k]) & (i + LENGTH <= (start + n)[k])]
    if len(i):
        some = np.zeros(len(n), bool)
        some[of[i]] = True
        kept = some[of]
        one, two, of, any_x = one[kept], two[kept], of[kept], any_x[kept]
        i = (np.cumsum(kept) - 1)[i]
        which = np.flatnonzero(some)
        start = np.cumsum(n[which] + 2 * DRIFT) - n[which] - DRIFT
        k = np.searchsorted(which, of[i])
        marked = np.zeros(len(one) + 2 * DRIFT, bool)
        total = np.zeros((2 * DRIFT + 1, len(one) + 1), np.int32)
        for e, same in enumerate(_beside(one, two)):
            marked[e : e + len(one)] |= same
            np.cumsum(same, out=total[e, 1:])
        often = total[:, start + n[which]] - total[:, start]
        of_x, of_y = _sums(any_x), _sums(marked)
        in_x = of_x[i + LENGTH] - of_x[i]
        best, shift = np.full(len(i), SHARED - 1, np.int32), np.zeros(len(i), np.int64)
        p, length = i - start[k], m[which][k]
        q = p + at[which][k]
        # at most LENGTH - SHARED shingles differ, so most of a passage lies at one distance
        for d in range(2 * DRIFT + 1):
            most = np.minimum(in_x, of_y[i + d + LENGTH] - of_y[i + d])
            t = np.flatnonzero((often[d] >= LENGTH // 4)[k] & (most > best) & (q + d >= DRIFT) & (q + d - DRIFT + LENGTH <= length))
            if not len(t):
                continue
            pairs = sum(total[e][i[t] + LENGTH - max(0, e - d)] - total[e][i[t] + max(0, d - e)] for e in range(2 * DRIFT + 1))
            shared = np.minimum(pairs, most[t])
            better = shared > best[t]
            best[t[better]], shift[t[better]] = shared[better], d - DRIFT
        good = best >= SHARED
        found.append((which[k][good], p[good], (q + shift)[good], best[good].astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def alike(x, x_at, n, y, y_at, m, at) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of many pairs of texts: the pair, passages of its x that a passage of its y at about that place repeats, the passages of y, and how many shingles they share.

    Pair k is x[x_at:x_at + n] and y[y_at:y_at + m], and passage p of the one lies at
    p + at of the other. Both windows of two such passages hold SHARED shingles that
    the other has no more than DRIFT places beside them. Pairs are taken together, up to
    TOGETHER shingles, as most are short.
    """
    found = [(np.zeros(0, np.int64),) * 4]
    long = np.flatnonzero(n >= LENGTH)
    done = np.append(0, np.cumsum(n[long]))
    lo = 0
    while lo < len(long):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + TOGETHER, "right")) - 1)
        here = long[lo:hi]
        k, *rest = _alike(x, x_at[here], n[here], y, y_at[here], m[here], at[here])
        found.append((here[k], *rest))
        lo = hi
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def similar(x: np.ndarray, y: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """alike for one pair of texts."""
    one = lambda v: np.array([v], np.int64)
    return alike(x, one(0), one(len(x)), y, one(0), one(len(y)), one(at))[1:]


def spans(pair: np.ndarray, at: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each pair, the runs [start, end) of words that passages (by where they start) cover, and the best similarity in each."""
    order = np.lexsort((at, pair))
    pair, at, shared = pair[order], at[order], shared[order]
    new = np.ones(len(at), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (np.diff(at) > LENGTH)
    first = np.flatnonzero(new)
    best = np.maximum.reduceat(shared, first) if len(first) else shared
    return pair[first], at[first], at[np.append(first[1:], len(at)) - 1] + LENGTH + SHINGLE - 1 if len(first) else first, best / (2 * LENGTH - best)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), np.append(0, np.cumsum(column.value_lengths().to_numpy())).astype(np.int64)


def _verified(parts):
    for part in parts:
        column = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
        (x, at_x), (y, at_y) = _lists(column("sa")), _lists(column("sb"))
        k = np.repeat(np.arange(part.num_rows), column("at").value_lengths().to_numpy())
        at = column("at").flatten()
        shift, lo, hi = (at.field(c).to_numpy().astype(np.int64) for c in ("shift", "lo", "hi"))
        a, b, x_lo, y_lo = (column(c).to_numpy()[k] for c in ("a", "b", "a_lo", "b_lo"))
        start = np.maximum(lo, 0)
        x_at, y_at = at_x[k] + start - x_lo, at_y[k]
        pair, p, q, shared = alike(x, x_at, np.minimum(hi + LENGTH - start, at_x[k + 1] - x_at), y, y_at, at_y[k + 1] - y_at, start - shift - y_lo)
        rows = []
        for one, two, places, base in ((a, b, p, start), (b, a, q, y_lo)):
            i, s, e, sim = spans(pair, places, shared)
            rows.append((one[i], two[i], base[i] + s, base[i] + e, sim))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(t) for c, t in zip(zip(*rows, strict=True), KINDS, strict=True)], NAMES)


def verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The repeats (doc_id, partner_id, start_word, end_word, similarity) that the pairs hold, in both documents."""
    in_b = lambda c: F.col(c) - F.col("shift")
    ends = [F.min("lo").alias("a_lo"), F.max("hi").alias("a_hi"), F.min(in_b("lo")).alias("b_lo"), F.max(in_b("hi")).alias("b_hi")]
    pairs = pairs.groupBy("a", "b").agg(F.collect_list(F.struct("shift", "lo", "hi")).alias("at"), *ends)
    pairs = pairs.withColumn("a_lo", F.greatest("a_lo", F.lit(0))).withColumn("b_lo", F.greatest(F.col("b_lo") - DRIFT, F.lit(0)))
    part = lambda lo, hi: F.slice("sh", F.col(lo) + 1, F.greatest(F.col(hi) + LENGTH + DRIFT - F.col(lo), F.lit(0)))
    pairs = pairs.join(held.withColumnRenamed("doc_id", "a"), "a").select(*pairs.columns, part("a_lo", "a_hi").alias("sa"))
    pairs = pairs.join(held.withColumnRenamed("doc_id", "b"), "b").select("a", "b", "at", "a_lo", "b_lo", "sa", part("b_lo", "b_hi").alias("sb"))
    return cut(pairs.mapInArrow(_verified, FOUND), "repeats")


def classes(found: DataFrame) -> DataFrame:
    """(id, root) of the documents that repeats link."""
    return components(found.where("doc_id > partner_id").select(F.col("doc_id").alias("a"), F.col("partner_id").alias("b")).distinct())


def _completed(parts):
    for part in parts:
        rows = []
        column = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023, E731
        sh, at = _lists(column("sh"))
        of = np.append(0, np.cumsum(column("spans").value_lengths().to_numpy()))
        flat = column("spans").flatten()
        start, end, partner, sim = (flat.field(c).to_numpy() for c in ("start_word", "end_word", "partner_id", "similarity"))
        for k, (doc, root) in enumerate(zip(column("doc_id").to_numpy().tolist(), column("root").to_numpy().tolist(), strict=True)):
            x = sh[at[k] : at[k + 1]].astype(np.int64).view(np.uint64)
            last = len(x) - LENGTH
            windows = contents(x, np.arange(last + 1), np.arange(last + 1))
            who, best = np.full(last + 1, np.iinfo(np.int64).max), np.zeros(last + 1)
            for i in range(of[k], of[k + 1]):
                here = slice(start[i], end[i] - LENGTH - SHINGLE + 2)
                who[here], best[here] = np.minimum(who[here], partner[i]), np.maximum(best[here], sim[i])
            # what is true of a passage is true of equal ones
            _, group = np.unique(windows, return_inverse=True)
            for f, values in ((np.minimum, who), (np.maximum, best)):
                of_group = values[np.unique(group, return_index=True)[1]]
                f.at(of_group, group, values)
                values[:] = of_group[group]
            p = np.flatnonzero(best)
            for run in np.split(p, np.flatnonzero(np.diff(p) > LENGTH) + 1):
                rows.append((doc, int(run[0]), int(run[-1]) + LENGTH + SHINGLE - 1, int(who[run].min()), float(best[run].max()), root))
        yield _batch(rows, ["doc_id", "start_word", "end_word", "partner_id", "similarity", "class_id"], [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int64()])


def _overlaps(flat: np.ndarray, at: np.ndarray, some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each of some cells and of others, the smaller count of their shingles that the other has too.

    Cell k is flat[at[k]:at[k + 1]], of shingles numbered from 0, or -1 for those that no other cell holds.
    """
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    width = int(flat.max(initial=-1)) + 1
    least = np.zeros((2, len(some), len(others)), np.float32)
    for lo in range(0, width, 1024):  # a bounded part of the matrix at once
        here = (flat >= lo) & (flat < lo + 1024)
        n = min(1024, width - lo)
        many = np.bincount(row[here] * n + (flat[here] - lo), minlength=(len(at) - 1) * n).reshape(-1, n).astype(np.float32)
        has = (many > 0).astype(np.float32)
        least[0] += many[some] @ has[others].T
        least[1] += has[some] @ many[others].T
    return least.min(0)


def _firsts(x: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The shingles of x that are among the first LENGTH - SHARED + 1 of one of its passages, those not in `common` before the others."""
    least = LENGTH - SHARED + 1
    with np.errstate(over="ignore"):
        rank = (tokens.mix(x.astype(np.int64).view(np.uint64)) >> np.uint64(2)) + (np.isin(x, common).astype(np.uint64) << np.uint64(62))
    windows = np.lib.stride_tricks.sliding_window_view(rank, LENGTH)
    last = np.partition(windows, least - 1, axis=1)[:, least - 1]
    chosen = np.zeros(len(x), bool)
    row, k = np.nonzero(windows <= last[:, None])
    chosen[row + k] = True
    return np.unique(x[chosen])


def _runs(parts, names: tuple[str, ...]):
    """Tables of whole groups of rows that agree in names, and where their groups start and end; the rows come in order."""
    waiting, edges, n, last = [], [], 0, None
    whole = lambda rows: pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    for part in parts:
        if not part.num_rows:
            continue
        part = pa.RecordBatch.from_arrays(part.columns, part.schema.names)
        k = np.column_stack([part.column(part.schema.get_field_index(c)).to_numpy() for c in names])
        new = np.flatnonzero(np.append(last is None or (k[0] != last).any(), (k[1:] != k[:-1]).any(1))).tolist()
        last = k[-1]
        if new and n + new[-1] >= ROWS:
            if n + new[-1]:
                yield whole([*waiting, part.slice(0, new[-1])]), np.array([*edges, *(n + x for x in new)])
            part, waiting, edges, n, new = part.slice(new[-1]), [], [], 0, [0]
        waiting.append(part)
        edges += [n + x for x in new]
        n += part.num_rows
    if n:
        yield whole(waiting), np.array([*edges, n])


MET = f"{FOUND}, key long, lo int, token int"


def _repeats(flat, at, doc, lo, mid, a, b) -> tuple[np.ndarray, list[tuple]]:
    """Which of the pairs of cells a and b repeat each other, and each one's rows of repeats."""
    size, base = np.diff(at), mid - lo
    pair, p, q, shared = alike(flat, at[a], size[a], flat, at[b], size[b], base[b] - base[a])
    rows = []
    for one, two, places in ((a, b, p), (b, a, q)):
        i, s, e, sim = spans(pair, places, shared)
        rows.append((i, doc[one[i]], doc[two[i]], lo[one[i]] + s, lo[one[i]] + e, sim))
    i, *columns = (np.concatenate(c) for c in zip(*rows, strict=True))
    of = {}
    for k, *row in zip(i.tolist(), *(c.tolist() for c in columns), strict=True):
        of.setdefault(k, []).append(tuple(row))
    return np.array(sorted(of), np.int64), of


def _joined(flat, at, doc, lo, mid, cls, a, b, made: list[tuple]) -> None:
    """Compare the pairs of cells a and b, in order, but those whose classes earlier ones joined; cls is changed."""
    step = 32
    while len(a):
        good, rows = _repeats(flat, at, doc, lo, mid, a[:step], b[:step])
        for k in good:
            i, j = a[k], b[k]
            if cls[i] != cls[j]:
                made += rows[int(k)]
                cls[cls == cls[j]] = cls[i]
        a, b = a[step:], b[step:]
        if len(good):
            left = cls[a] != cls[b]
            a, b = a[left], b[left]
        step = 32 if len(good) else min(2 * step, SIDE)


def _in_groups(name, *by) -> np.ndarray:
    """The last row, in the order of the last of by, of the rows of a group that agree in the others."""
    order = np.lexsort((*by[::-1], name))
    last = np.zeros(len(order), bool)
    last[-1:] = True
    for x in (name, *by[:-1]):
        last[:-1] |= x[order][1:] != x[order][:-1]
    return order[last]


def _met(parts, split: bool):
    """Of each block of a group's cells and its heads: repeats that join classes; for groups to be split, the cells' first shingles."""
    made, firsts = [], []
    for run, edges in _runs(parts, ("key", "block")):
        column = lambda c: run.column(run.schema.get_field_index(c))  # noqa: B023, E731
        flat, at = _lists(column("sh"))
        doc, lo, mid, cls, u, n, head, own = (column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "lo", "mid", "cls", "u", "n", "head", "own"))
        cls = cls.copy()
        group = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
        # equal cells of a class count once in a group that is compared whole; these are ordered by u
        whole = np.flatnonzero(n <= SIDE)
        once = whole[_in_groups(group[whole], cls[whole], contents(flat.astype(np.int64).view(np.uint64), at[:-1], at[1:] - LENGTH)[whole], u[whole])]
        once = once[np.lexsort((lo[once], doc[once], u[once], group[once]))]
        size = np.bincount(group[once], minlength=len(edges) - 1)
        base = np.cumsum(size) - size
        # all pairs of many small groups at once
        few = np.flatnonzero(size <= FEW)
        area = size[few] ** 2
        k = np.repeat(few, area)
        place = np.arange(len(k)) - np.repeat(np.cumsum(area) - area, area)
        i, j = place // np.maximum(size[k], 1), place % np.maximum(size[k], 1)
        a, b = once[(base[k] + i)[i < j]], once[(base[k] + j)[i < j]]
        far = (cls[a] != cls[b]) & (doc[a] != doc[b])
        a, b = a[far], b[far]
        good, rows = _repeats(flat, at, doc, lo, mid, a, b)
        for x in good:
            i, j = a[x], b[x]
            if cls[i] != cls[j]:
                made += rows[int(x)]
                here = cls[edges[group[i]] : edges[group[i] + 1]]
                here[here == cls[j]] = cls[i]
        for g in np.flatnonzero((size > FEW) | (n[edges[:-1]] > SIDE)).tolist():
            here = np.arange(edges[g], edges[g + 1])
            all_pairs = n[here[0]] <= SIDE
            some_cells = once[base[g] : base[g] + size[g]] if all_pairs else here
            one_at = np.append(0, np.cumsum(np.diff(at)[some_cells]))
            index = np.arange(one_at[-1]) + np.repeat(at[some_cells] - one_at[:-1], np.diff(one_at))
            _large(flat[index], one_at, *(c[some_cells] for c in (doc, lo, mid, cls, u, head, own)), all_pairs, made)
            if split and not all_pairs:
                common = np.concatenate([np.zeros(0, np.int32), *(flat[at[i] : at[i + 1]] for i in here[head[here]])])
                key = column("key")[here[0]].as_py()
                for i in here[own[here]]:
                    firsts += [(doc[i], key, lo[i], t) for t in _firsts(flat[at[i] : at[i + 1]], common)]
        if len(made) + len(firsts) > 20000:
            yield _both(made, firsts)
            made, firsts = [], []
    yield _both(made, firsts)


def _large(flat, at, doc, lo, mid, cls, u, head, own, all_pairs: bool, made: list[tuple]) -> None:
    """Compare all cells of a group, or its own cells with its heads; cells that share enough shingles, wherever, are verified."""
    if all_pairs:
        head = own = np.ones(len(doc), bool)
    _, number, often = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[number]
    heads, members = np.flatnonzero(head), np.flatnonzero(own)
    # of two cells of different classes one at least is outside the largest class
    _, of_kind, many = np.unique(cls, return_inverse=True, return_counts=True)
    minor = of_kind != np.argmax(many)
    sides = [(heads[minor[heads]], members), (heads[~minor[heads]], members[minor[members]])]
    for some, others in ((x[i : i + 256], y) for x, y in sides for i in range(0, len(x), 256)):
        if not len(others) or all_pairs and not minor[some[0]]:
            continue
        later = (u[others] > u[some][:, None]) | ((u[others] == u[some][:, None]) & (others > some[:, None]))
        if all_pairs:  # pairs with the largest class are met from the other side alone
            later |= ~minor[others]
        near = later & (doc[some][:, None] != doc[others]) & (cls[some][:, None] != cls[others])
        if near.any():
            near &= _overlaps(number, at, some, others) >= SHARED
        i, j = np.nonzero(near)
        _joined(flat, at, doc, lo, mid, cls, some[i], others[j], made)


def _both(made: list[tuple], firsts: list[tuple]) -> pa.RecordBatch:
    rows = [(*r, None, None, None) for r in made] + [(d, None, None, None, None, key, lo, t) for d, key, lo, t in firsts]
    return _batch(rows, [*NAMES, "key", "lo", "token"], [*KINDS, pa.int64(), pa.int32(), pa.int32()])


def settled(found: DataFrame, cells: DataFrame, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """found with the repeats between cells of a group that the first links have left in different classes, and the classes of all."""
    roots = classes(found)
    u = F.shiftrightunsigned(F.xxhash64("doc_id", "lo"), 11) / F.lit(2.0**53)
    rows, done, split = cells.withColumn("u", u), 0, True
    while True:
        covered = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans")).join(roots, "id")
        seen = F.coalesce(F.exists("spans", lambda s: (s.start_word <= F.col("hi")) & (s.end_word - LENGTH - SHINGLE + 1 >= F.col("lo"))), F.lit(False))
        at = rows.join(covered.hint("merge"), F.col("doc_id") == F.col("id"), "left").withColumn("seen", seen)
        # documents without a repeat in the cell are classes of their own
        at = cut(at.select(*rows.columns, F.xxhash64("seen", F.when(F.col("seen"), F.col("root")).otherwise(F.col("doc_id"))).alias("cls")), "classed")
        mixed = at.groupBy("key").agg(F.min("cls").alias("least"), F.max("cls").alias("most"), F.count("*").alias("n")).where("least < most").where(F.col("n") > done).select("key", "n")
        left = salted_left_join(at, mixed, ["key"], ["doc_id", "lo"], hint="merge").where("n is not null")
        left = cut(left, "open")
        if not left.limit(1).count():
            return found, roots
        more = done + HEADS[not split]
        head = (F.col("n") <= SIDE) | ((F.col("u") * F.col("n") >= done) & (F.col("u") * F.col("n") < more))
        sh = F.slice("sh", F.col("lo") + 1, F.col("hi") - F.col("lo") + LENGTH)
        full = left.join(held.hint("merge"), "doc_id").select(*left.columns, sh.alias("sh")).withColumn("head", head)
        blocks = F.ceil(F.col("n") / SIDE).cast("int")
        full = full.withColumn("home", F.pmod(F.xxhash64(F.lit("block"), "doc_id", "lo"), blocks).cast("int"))
        everywhere = F.when(F.col("head"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array("home"))
        dealt = full.withColumn("block", F.explode(everywhere)).withColumn("own", F.col("block") == F.col("home"))
        dealt = dealt.repartition("key", "block").sortWithinPartitions("key", "block")
        now = split
        got = cut(dealt.select("key", "block", "doc_id", "lo", "mid", "cls", "u", "n", "head", "own", "sh").mapInArrow(lambda parts: _met(parts, now), MET), "met")
        found = cut(found.union(got.where("partner_id is not null").select(*NAMES)), "repeats")
        roots = classes(found)
        if split:
            part = got.where("token is not null").select("key", "doc_id", "lo", "token")
            part = salted_left_join(part, part.groupBy("key", "token").agg(F.count("*").alias("__n")).where("__n > 1"), ["key", "token"], ["doc_id", "lo"], hint="merge").where("__n is not null")
            rows = part.join(left.where(F.col("n") > SIDE).select("key", "doc_id", "lo", "hi", "mid", "u").hint("merge"), ["key", "doc_id", "lo"])
            rows = rows.select(F.xxhash64("key", "token").alias("key"), "doc_id", "lo", "hi", "mid", "u")
            done, split = 0, False
        else:
            rows, done = left.where(F.col("n") > more).select(*rows.columns), more


def repeated_passages(docs: DataFrame) -> DataFrame:
    """The passages of each document that other documents repeat.

    doc_id, start_word, end_word (of words, from 0, end exclusive; a stretch of repeated
    passages that overlap or touch), partner_id (the smallest document that holds a
    passage of the stretch and was verified), similarity (of the best passage) and
    class_id: the smallest document that the document's links reach. Documents
    without repeats have no row.
    """
    small_batches(docs.sparkSession)
    pairs, cells = links(docs)
    pairs, cells = cut(pairs, "pairs"), cut(cells, "cells")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    held = cut(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(_arrays, "doc_id long, sh array<int>").groupBy("doc_id").agg(F.max_by("sh", F.size("sh")).alias("sh")), "shingles")
    found, roots = settled(verified(pairs, held), cells, held)
    of_doc = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word", "partner_id", "similarity")).alias("spans"))
    of_doc = of_doc.join(roots.withColumnRenamed("id", "doc_id"), "doc_id").join(held, "doc_id")
    return of_doc.select("doc_id", "root", "spans", "sh").mapInArrow(_completed, "doc_id long, start_word int, end_word int, partner_id long, similarity double, class_id long")
