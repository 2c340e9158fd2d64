"""Line dedup, BagMinHash and repeated passages against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gristmill.llm import bagminhash, lines, passages
from gristmill.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WS = " \t\n\x0b\x0c\r"


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], schema)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


# --- lines ---------------------------------------------------------------------------------------------------------


def key_of(line):
    return line.strip(WS).translate({c: c + 32 for c in range(65, 91)})


def brute_lines(rows):
    held = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key_of(line)) >= 40:
                    held[key_of(line)].add(i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if not (i is not None and len(held[key_of(x)]) >= 5 and len(key_of(x)) >= 40 and i < max(held[key_of(x)]))]
        out.append((i, len(parts), len(parts) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def line_rows():
    r = random.Random(1)
    shared = [prose(r, 12) for _ in range(6)]
    short = "short line"
    rows = []
    for i in range(60):
        parts = [prose(r, 9) for _ in range(r.randint(1, 4))] + [short]
        for k, s in enumerate(shared):
            if i % (k + 2) == 0:
                parts.insert(r.randint(0, len(parts)), ("\t " + s.upper() + " ") if i % 4 == 0 else s)
        if i % 7 == 0:
            parts += [shared[0], shared[0]]
        rows.append((i, "\n".join(parts)))
    return [*rows, (60, None), (61, ""), (62, "\n\n"), (None, shared[0]), (5, rows[5][1]), (63, ("x" * 50 + "\n") * 3000)]


def test_line_dedup_equals_brute_force(spark):
    rows = line_rows()
    got = sorted(map(tuple, lines.digests(frame(spark, rows)).collect()), key=str)
    assert got == brute_lines(rows)
    assert any(g[2] for g in got)


def test_line_dedup_of_nothing_and_with_clashing_columns(spark):
    assert lines.digests(frame(spark, [])).collect() == []
    docs = spark.createDataFrame([(i, "z" * 45, 7, 8, 9) for i in range(6)], "doc_id long, text string, n_lines long, keys long, n long")
    out = lines.drop_lines(docs)
    assert out.columns[:5] == docs.columns
    assert sorted((r["doc_id"], r["text"], r["keys"]) for r in out.collect()) == [*((i, "", 8) for i in range(5)), (5, "z" * 45, 8)]


def test_line_index_is_reversible(spark):
    rows = [(i, t) for i, t in line_rows() if i is not None][:60]
    first, rest = rows[:40], rows[40:]
    grown = lines.LineIndex.build(frame(spark, first)).insert(frame(spark, rest))
    back = grown.delete(spark.createDataFrame([(i,) for i, _ in rest], "doc_id long"))
    for index, of in ((grown, rows), (back, first)):
        out = lines.drop_lines(frame(spark, of).select("doc_id", "text"), index)
        got = sorted((r["doc_id"], r["__n_lines"], r["__n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in out.collect())
        assert got == sorted(brute_lines(of))
    assert {tuple(r) for r in back.refs.collect()} == {tuple(r) for r in lines.LineIndex.build(frame(spark, first)).refs.collect()}


def test_filters_grow_with_the_index(spark, monkeypatch):
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 2)
    r = random.Random(21)
    keys = [prose(r, 12) for _ in range(12)]
    rows = [(i, "\n".join(keys[: 1 if i < 6 else 12])) for i in range(20)]
    first, rest = frame(spark, rows[:6]), frame(spark, rows[6:])
    index = lines.LineIndex.build(first)
    grown = index.insert(rest)
    assert index.shards == 1 and grown.shards == 6
    assert sorted(k for f in grown.filters.collect() for k in f["held"]) == sorted(x["k1"] for x in grown.refs.where("n >= 5").collect())
    out = lines.drop_lines(frame(spark, rows).select("doc_id", "text"), grown)
    assert sorted((x["doc_id"], x["__n_dropped"]) for x in out.collect()) == sorted((i, d) for i, _, d, _ in brute_lines(rows))


def test_cuckoo_filter_holds_what_was_inserted():
    r = random.Random(2)
    keys = [r.randrange(-(2**63), 2**63) for _ in range(500)]
    own = lines.Cuckoo()
    for k in keys:
        own.insert(k)
    assert all(k in own for k in keys)
    for k in keys[:250]:
        own.delete(k)
    assert all(k in own for k in keys[250:]) and list(own.held) == keys[250:]
    assert sum(k in own for k in keys[:250]) < 10


# --- BagMinHash ----------------------------------------------------------------------------------------------------


def bag(text):
    words = (text or "").split()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def jaccard(a, b):
    low, high = sum((a & b).values()), sum((a | b).values())
    return low / high if high else 0


def brute_classes(rows):
    rows = [(i, t or "") for i, t in rows if i is not None]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = [(i, t, bag(t)) for i, t in rows]
    for n, (i, t, a) in enumerate(bags):
        for j, u, b in bags[:n]:
            if t == u or jaccard(a, b) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def near_rows():
    r = random.Random(3)
    rows = []
    for g in range(12):
        base = prose(r, 150).split()
        for c in range(g % 4 + 1):
            w = list(base)
            for _ in range(c):
                w[r.randrange(len(w))] = prose(r, 1)
            rows.append((len(rows), " ".join(w)))
    loop = prose(r, 10)
    rows += [(len(rows), " ".join([loop] * 20)), (len(rows) + 1, " ".join([loop] * 21)), (len(rows) + 2, " ".join([loop] * 3))]
    n = len(rows)
    return [*rows, (n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, "one two"), (n + 4, "one three"), (0, rows[0][1]), (None, rows[0][1]), (n + 5, prose(r, 30000))]


def test_classes_equal_brute_force(spark):
    rows = near_rows()
    got = bagminhash.classes(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_classes(rows)
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == want
    assert [r["class_id"] for r in got if r["doc_id"] is None] == [None]
    kept = bagminhash.keep_one(frame(spark, rows))
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("heads", [bagminhash.HEADS, (1, 3)])
def test_copies_that_only_their_base_joins_are_one_class(spark, monkeypatch, heads):
    monkeypatch.setattr(bagminhash, "HEADS", heads)
    monkeypatch.setattr(bagminhash, "BLOCK", 4)
    r = random.Random(11)
    base = prose(r, 150).split()
    rows = [(40, " ".join(base))]
    for i in range(25):
        w = list(base)
        for k in r.sample(range(5, 145, 10), 3):
            w[k] = prose(r, 1) + str(i)
        rows.append((i, " ".join(w)))
    assert sum(jaccard(bag(rows[i][1]), bag(rows[j][1])) < 0.8 for i in range(1, 26) for j in range(1, i)) > 200
    rows += [(3, rows[4][1])] * 3
    want = brute_classes(rows)
    assert set(want.values()) == {0}
    assert {x["doc_id"]: x["class_id"] for x in bagminhash.classes(frame(spark, rows)).collect()} == want


def test_classes_of_nothing(spark):
    assert bagminhash.classes(frame(spark, [])).collect() == []


@pytest.mark.parametrize(("a", "b"), [({1: 1, 2: 1, 3: 1}, {2: 1, 3: 1, 4: 1}), ({1: 7, 2: 3, 5: 1}, {1: 4, 2: 3, 6: 5}), ({1: 33, 2: 1}, {1: 20, 3: 9})])
def test_signatures_estimate_weighted_jaccard(a, b):
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    found = []
    for trial in range(40):
        h = lambda d: np.array([hash((trial, k)) & 0xFFFFFFFFFFFF for k in d], np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # noqa: B023, E731
        text = np.repeat([0, 1], [len(a), len(b)])
        sig = bagminhash.signatures(text, np.concatenate([h(a), h(b)]), np.array([*a.values(), *b.values()]), 2)
        assert np.isfinite(sig).all()
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - want) < 0.03


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (12, 11), (5, 5), (100, 3)] + [(200 + i, 201 + i) for i in range(40)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 100: 1, 10: 10, 11: 10, 12: 10} | {200 + i: 200 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- passages ------------------------------------------------------------------------------------------------------


def brute_windows(v, least):
    found = set()

    def grow(s, e):
        if e - s >= least:
            c = s + int(np.argmin(v[s:e]))
            found.add((s, c, e - 1))
            grow(s, c)
            grow(c + 1, e)

    grow(0, len(v))
    return found


def test_compact_windows_equal_a_recursive_cartesian_tree():
    r = np.random.default_rng(4)
    texts = [r.integers(0, 2**60, n).astype(np.uint64) for n in (0, 3, 50, 333)]
    at = np.cumsum([0, *map(len, texts)])
    got = set(zip(*(x.tolist() for x in passages.compact_windows(np.concatenate(texts), at[:-1], at[1:], 5)), strict=True))
    want = {(s + o, c + o, e + o) for t, o in zip(texts, at, strict=False) for s, c, e in brute_windows(t, 5)}
    assert got == want
    # every stretch of 5 is in exactly one window that holds its minimum
    for t, o in zip(texts, at, strict=False):
        for p in range(len(t) - 4):
            c = o + p + int(np.argmin(t[p : p + 5]))
            assert sum(lo <= o + p and o + p + 4 <= hi and m == c for lo, m, hi in got) == 1


def test_repeated_passages(spark):
    r = random.Random(5)
    shared = [prose(r, n) for n in (51, 60, 120)]
    rows = [(i, prose(r, 200)) for i in range(30)]
    want = defaultdict(list)
    for k, s in enumerate(shared):
        for i in range(k, 12 + k, 3):
            w = rows[i][1].split()
            at = r.randint(0, len(w))
            rows[i] = (i, " ".join([*w[:at], s, *w[at:]]))
            want[i].append(s)
    near = shared[2].split()
    near[60] = "changed"
    rows.append((30, prose(r, 80) + " " + " ".join(near) + " " + prose(r, 80)))
    want[30].append(" ".join(near))
    short = prose(r, 30)
    rows += [(31, prose(r, 60) + " " + short), (32, short + " " + prose(r, 60)), (33, None), (34, ""), (35, "few words"), (None, shared[0])]
    rows += [(36, rows[29][1]), (29, rows[29][1])]
    got = passages.repeated_passages(frame(spark, rows)).collect()
    text = dict(r for r in rows if r[0] is not None)
    found = defaultdict(list)
    for g in got:
        found[g["doc_id"]].append(" ".join((text[g["doc_id"]]).split()[g["start_word"] : g["end_word"]]))
        assert g["class_id"] <= g["doc_id"] and g["partner_id"] != g["doc_id"] and g["similarity"] >= 0.8
    assert set(found) == set(want) | {29, 36}
    for i, passages_of in want.items():
        for s in passages_of:
            assert any(s in f for f in found[i]), (i, s)
    assert passages.repeated_passages(frame(spark, [])).collect() == []


@pytest.mark.parametrize("most", [1, passages.MAX_CELLS])
def test_every_place_of_a_passage_in_the_head_is_found(spark, monkeypatch, most):
    monkeypatch.setattr(passages, "MAX_CELLS", most)
    r = random.Random(7)
    shared = prose(r, 60)
    rows = [(0, f"{shared} {prose(r, 400)} {shared} {prose(r, 50)}"), (1, f"{prose(r, 80)} {shared}"), (2, f"{shared} {prose(r, 90)}")]
    got = passages.repeated_passages(frame(spark, rows).coalesce(1)).collect()
    spans = [(g["start_word"], g["end_word"]) for g in got if g["doc_id"] == 0]
    for at in (0, 460):
        assert any(s <= at and at + 60 <= e for s, e in spans), (at, spans)
    assert {g["doc_id"] for g in got} == {0, 1, 2}


def shingles_of(text):
    w = (text or "").split()
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute_repeats(rows):
    """Words of each document that lie in a passage of 46 shingles with a Jaccard similarity of 0.8 to one of another document."""
    sh = {i: shingles_of(t) for i, t in rows}
    words = defaultdict(set)
    for i, x in sh.items():
        for j, y in sh.items():
            if i == j or not set(x) & set(y):
                continue
            at = defaultdict(list)
            for q, s in enumerate(y):
                at[s].append(q)
            for p in range(len(x) - 45):
                one = set(x[p : p + 46])
                near = {q for s in one for k in at[s] for q in range(max(0, k - 45), min(k, len(y) - 46) + 1)}
                for q in near:
                    both = len(one & (two := set(y[q : q + 46])))
                    if both / (len(one) + len(two) - both) >= 0.8:
                        words[i] |= set(range(p, p + 50))
                        break
    return words


def covered(got):
    words = defaultdict(set)
    for g in got:
        words[g["doc_id"]] |= set(range(g["start_word"], g["end_word"]))
    return words


@pytest.mark.parametrize(("side", "heads"), [(512, (64, 4096)), (8, (2, 20))])
def test_repeats_are_those_of_brute_force(spark, monkeypatch, side, heads):
    """Nothing but what brute force finds, and (min-hashes are random) nearly all of it."""
    monkeypatch.setattr(passages, "SIDE", side)
    monkeypatch.setattr(passages, "HEADS", heads)
    r = random.Random(31)
    shared, line = [prose(r, n).split() for n in (55, 70, 130)], prose(r, 30)
    rows = []
    for i in range(24):
        w = list(shared[i % 3])
        for _ in range(i % 5):  # from none to four words changed, left out or put in
            k = r.randrange(len(w))
            w[k : k + r.choice([0, 1, 1])] = r.choice([[], [prose(r, 1)]])
        # a common line that is too short, and half a passage, scattered
        scattered = " ".join(" ".join(shared[(i + 1) % 3][k : k + 9]) + " " + prose(r, 2) for k in range(0, 40, 9))
        rows.append((i, " ".join([prose(r, 60), line, prose(r, r.randint(5, 20)), " ".join(w), prose(r, 40), scattered])))
    rows.append((99, " ".join([prose(r, 30), " ".join(shared[0]), prose(r, 80), " ".join(shared[0]), prose(r, 5)])))
    rows.append((98, (prose(r, 9) + " ") * 30))
    want, got = brute_repeats(rows), covered(passages.repeated_passages(frame(spark, rows)).collect())
    surplus, missed = sum(len(got[i] - want[i]) for i in got), sum(len(want[i] - got[i]) for i in want)
    total = sum(map(len, want.values()))
    print("words repeated", total, "missed", missed, "surplus", surplus)
    assert total > 1000 and surplus == 0 and missed <= 0.03 * total


def test_scattered_shingles_are_no_passage():
    x = np.arange(100, 200)
    y = np.concatenate([np.concatenate([x[k : k + 9], 1000 + np.arange(k * 40, k * 40 + 40)]) for k in range(0, 99, 9)])
    assert len(passages.similar(x, y, 0)[0]) == 0
    p, q, shared = passages.similar(x, np.concatenate([[1, 2, 3], x]), 1)
    assert p.tolist() == list(range(55)) and q.tolist() == list(range(3, 58)) and (shared == 46).all()
    loop = np.array([7, 7, 7, 8] * 25)
    assert len(passages.similar(loop, np.concatenate([np.arange(40), loop[:30], np.arange(300, 340)]), 40)[0]) == 0


def brute_alike(x, y, at):
    """Passages p of x, q of y and the shingles they share, by the definition, one pair of texts and one passage at a time."""
    drift, length = passages.DRIFT, passages.LENGTH
    same = {(i, e) for i in range(len(x)) for e in range(-drift, drift + 1) if 0 <= at + i + e < len(y) and x[i] == y[at + i + e]}
    often = Counter(e for _, e in same)
    in_x, in_y = {i for i, _ in same}, {at + i + e for i, e in same}
    if often[0] == len(x):  # y holds all of x in place
        yield from ((p, p + at, length) for p in range(len(x) - length + 1))
        return
    for p in range(len(x) - length + 1):
        best, place = 0, 0
        for d in range(-drift, drift + 1):
            q = p + at + d
            if often[d] < length // 4 or q < 0 or q + length > len(y):
                continue
            one, two = range(p, p + length), range(q, q + length)
            pairs = sum((i, e) in same and at + i + e in two for i in one for e in range(-drift, drift + 1))
            shared = min(pairs, len(in_x & set(one)), len(in_y & set(two)))
            best, place = max((best, place), (shared, q), key=lambda b: b[0])
        if best >= passages.SHARED:
            yield p, place, best


def edited(r, x):
    x = x.tolist()
    for _ in range(r.integers(0, 6)):
        k = r.integers(len(x))
        x[k : k + r.integers(0, 2)] = r.integers(1000, 9000, r.integers(0, 2)).tolist()
    return np.array(x, np.int32)


def test_many_pairs_of_texts_are_verified_together(monkeypatch):
    r = np.random.default_rng(17)
    xs = [r.integers(0, 500 if k % 7 else 3, r.integers(0, 120)).astype(np.int32) for k in range(300)]
    ys = [np.concatenate([r.integers(0, 500, k % 9), edited(r, x) if len(x) and k % 5 else x, r.integers(0, 500, k % 4)]).astype(np.int32) for k, x in enumerate(xs)]
    at = np.array([k % 9 + r.integers(-3, 4) * (k % 3 == 0) for k in range(300)])
    want = [(k, *f) for k in range(300) for f in brute_alike(xs[k], ys[k], int(at[k]))]
    n, m = (np.array([len(t) for t in ts]) for ts in (xs, ys))
    calls, once = [], passages._alike
    monkeypatch.setattr(passages, "_alike", lambda *a: calls.append(1) or once(*a))
    for together, most in ((1 << 16, 1), (500, 60), (1, 300)):
        monkeypatch.setattr(passages, "TOGETHER", together)
        calls.clear()
        got = passages.alike(np.concatenate(xs), np.cumsum(n) - n, n, np.concatenate(ys), np.cumsum(m) - m, m, at)
        assert sorted(zip(*(c.tolist() for c in got), strict=True)) == sorted(want) and len(calls) <= most
    assert len(want) > 1000


def test_groups_of_all_sizes_are_joined_as_pair_by_pair(monkeypatch):
    r = np.random.default_rng(19)
    rows = []
    for key in range(40):
        near = [r.integers(0, 10**6, 50) for _ in range(r.integers(1, 4))]
        for _ in range(r.integers(2, 30)):
            kind = r.integers(len(near))
            x = near[kind].copy()
            x[r.choice(50, r.integers(0, 9), replace=False)] = r.integers(10**6, 10**7)
            rows.append((key, 0, int(r.integers(25)), 3, 20, int(r.integers(4)), r.random(), x.astype(np.int32)))
    size = Counter(x[0] for x in rows)
    want = {}
    for key in range(40):
        here = [x for x in rows if x[0] == key]
        label = [x[5] for x in here]
        for i, x in enumerate(here):
            for j, y in enumerate(here):
                if x[2] != y[2] and label[i] != label[j] and len(passages.similar(x[7], y[7], 0)[0]):
                    label = [label[i] if c == label[j] else c for c in label]
        want[key] = len(set(label))
    names = ["key", "block", "doc_id", "lo", "mid", "cls", "u", "sh"]
    columns = [list(c) for c in zip(*rows, strict=True)]
    table = pa.table({**dict(zip(names, columns, strict=True)), "n": [size[k] for k in columns[0]], "head": [True] * len(rows), "own": [True] * len(rows)})
    calls, once = [], passages._repeats
    monkeypatch.setattr(passages, "_repeats", lambda *a: calls.append(1) or once(*a))
    for few, read, batch in ((32, 2048, 512), (0, 1, 7), (5, 50, 1000)):
        monkeypatch.setattr(passages, "FEW", few)
        monkeypatch.setattr(passages, "ROWS", read)
        calls.clear()
        made = [b.to_pylist() for b in passages._met(iter(table.to_batches(max_chunksize=batch)), False)]
        joined = sum(len(b) for b in made)
        assert joined == 2 * sum(len({x[5] for x in rows if x[0] == key}) - want[key] for key in range(40)) > 0
        assert few < 32 or len(calls) == 1


def test_firsts_meet_wherever_passages_are_alike():
    r = np.random.default_rng(8)
    common = np.arange(60).astype(np.int32)
    for _ in range(60):
        x = common[:55].copy()
        y = common[:55].copy()
        x[r.choice(55, 6, replace=False)] = r.integers(1000, 9000, 6)
        y[r.choice(55, 6, replace=False)] = r.integers(1000, 9000, 6)
        alike = any(len(set(x[p : p + 46]) & set(y[q : q + 46])) >= passages.SHARED for p in range(10) for q in range(10))
        assert not alike or len(np.intersect1d(passages._firsts(x, common), passages._firsts(y, common)))


def keys_of(text):
    buf = np.frombuffer(text.encode(), np.uint8)
    words, of, _ = passages.tokens.word_hashes(buf, np.array([0, len(buf)]))
    h = passages.tokens.shingles(words, passages.SHINGLE)
    return set(passages.cells(h, of[:-1], of[1:] - passages.SHINGLE + 1)[0].tolist())


@pytest.mark.parametrize("slices", [1, 3])
def test_alike_passages_are_linked_where_no_head_resembles_them(spark, slices):
    r = random.Random(13)
    rows = []
    while len(rows) < 9:
        w = prose(r, 50).split()
        head, a, b = " ".join([*prose(r, 6).split(), *w[6:]]), " ".join(w), " ".join([*w[:49], "last"])
        # all signatures that the two share are the head's too, with which they share 40 and 39 of 46 shingles
        if (keys_of(a) & keys_of(b)) and (keys_of(a) & keys_of(b)) <= keys_of(head):
            rows += [(len(rows) + k, t) for k, t in enumerate((head, a, b))]
    got = passages.repeated_passages(frame(spark, rows).repartition(slices)).collect()
    assert {g["doc_id"]: g["class_id"] for g in got} == {1: 1, 2: 1, 4: 4, 5: 4, 7: 7, 8: 7}
