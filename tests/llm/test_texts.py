"""Classifiers, SentencePiece, rules, mixing, WARC, search and the pipeline."""

import base64
import datetime
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gristmill.llm import mixing, multiprobe, pu, quality, queries, rules, sentencepiece_codec, tokens, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


# --- words ---------------------------------------------------------------------------------------------------------


def test_words_are_hashed_as_the_pattern_splits_them(monkeypatch):
    texts = ["a b\tc", None, "", "  ", "é\x0bü 漢字 x", "longer" * 50 + " z", "a b\tc", "\x1f \xa0 a"]
    for size in (1 << 19, 7):
        monkeypatch.setattr(tokens, "CHUNK", size)
        buf, at = tokens.raw(pa.array(texts))
        h, of, _ = tokens.word_hashes(buf, at)
        words = [WORD.findall(t or "") for t in texts]
        assert list(np.diff(of)) == [len(w) for w in words]
        by = defaultdict(set)
        for w, x in zip([w for t in words for w in t], h.tolist(), strict=True):
            by[w].add(x)
        assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)
    assert tokens.raw(pa.array(texts).slice(4, 2))[1][-1] == len((texts[4] + texts[5]).encode())


# --- classifiers -----------------------------------------------------------------------------------------------------


def test_nonnegative_risk_finds_the_class_without_negatives():
    r = np.random.default_rng(0)
    pos, unl = r.normal(2, 1, (600, 3)), np.concatenate([r.normal(2, 1, (300, 3)), r.normal(-2, 1, (700, 3))])
    net = pu.train(pos, unl, 0.3, epochs=30)
    assert (pu.sigmoid(net.forward(r.normal(2, 1, (500, 3)))) > 0.5).mean() > 0.97
    assert (pu.sigmoid(net.forward(r.normal(-2, 1, (500, 3)))) < 0.5).mean() > 0.97
    assert pu.class_prior(100, 0, 0) == 0 and abs(pu.class_prior(1000, 500, 100) - 100 / 900) < 1e-9


def auc(y, s):
    order = np.argsort(np.argsort(s, kind="stable"))
    return (order[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


@pytest.mark.parametrize(("name", "label", "least"), [("op1_toxicity", "toxic", 0.75), ("op2_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    out = queries.QUERIES[name](spark, DATA).toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all()
    labels = spark.read.parquet(f"{DATA}/labels.parquet").toPandas()
    both = out[out.held_out].merge(labels)
    assert auc(both[label].to_numpy(), both.score.to_numpy()) > least
    assert list(out.held_out) == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]
    assert (out.predicted == (out.score >= {"toxic": 0.3, "quality": 0.7}[label])).all()


def test_classifiers_take_odd_rows_and_no_labels(spark):
    rows = [(1, None, "s"), (2, "", "s"), (None, "words here", None), (2, "", "s"), (3, "w " * 40000, "s")]
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 1), (3, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for f in (toxicity.toxicity, quality.quality):
        for known in (labels, none):
            out = f(docs_of(spark, rows).withColumn("score", pa_lit()), known).collect()
            assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
        assert f(docs_of(spark, []), labels).collect() == []
    extra = docs_of(spark, rows).withColumn("score", pa_lit())
    assert quality.keep_good(extra, labels).columns == extra.columns


def test_no_more_rows_are_fitted_than_the_bound(spark):
    rows = [(1, f"same id {i}", "s") for i in range(1000)] + [(i, f"text {i}", "s") for i in range(3, 60)]
    labels = spark.createDataFrame([(i, 1, 1) for i in (1, 3, 4, 5, 6, 7)], "doc_id long, quality int, toxic int")
    sample, _ = toxicity.fitting_sample(docs_of(spark, rows), labels, "toxic", 4, 4)
    assert len(sample.collect()) == 8
    sample, _ = toxicity.fitting_sample(docs_of(spark, rows[:1000]), labels, "toxic", 4, 4)
    assert [tuple(r) for r in sample.collect()] == [("same id 999", True)]


def test_gradient_follows_the_risk():
    """The step's gradient against differences of the risk as the paper writes it."""
    r = np.random.default_rng(3)
    pos, unl, prior = r.normal(1, 1, (40, 4)), r.normal(0, 1, (90, 4)), 0.3
    net = pu.Net(4, 5, 1)

    def risk():
        loss = lambda z: np.log1p(np.exp(-z)).mean()
        gp, gu = net.forward(pos), net.forward(unl)
        return prior * loss(gp) + max(0, loss(-gu) - prior * loss(-gp))

    gp, gu = pu.sigmoid(net.forward(pos)), pu.sigmoid(net.forward(unl))
    own = [a + b for a, b in zip(net.gradient(pos, prior * (-(1 - gp) - gp) / len(pos)), net.gradient(unl, gu / len(unl)), strict=True)]
    for p, g in zip(net.p, own, strict=True):
        for k in np.ndindex(p.shape):
            was, step = p[k], 1e-6
            p[k] = was + step
            up = risk()
            p[k] = was - step
            down = risk()
            p[k] = was
            assert abs((up - down) / (2 * step) - g[k]) < 1e-6


def pa_lit():
    from pyspark.sql import functions as F

    return F.lit(5)


# --- SentencePiece -----------------------------------------------------------------------------------------------------

TEXTS = ["", "Hello  world", " lead", "tail  ", "日本語 ünïcode 😀😀", "a\u0000b", "\t\n x", "ﬁ ① ｶﾞ Å", "ḱṷṓn x́", "Ⅷ½ №", "▁▁ a", "x" * 5000, "😀" * 50]


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return sentencepiece_codec.load(public_tokenizers.path("piece_bpe_32k.model"))


def test_spans_equal_the_library(model):
    own = sentencepiece_codec.Codec(model)
    for t in TEXTS:
        proto = own.processor.encode(t, return_type="proto")
        starts, ends = own.spans(t, [p.id for p in proto.pieces])
        got = list(zip(starts.tolist(), ends.tolist(), strict=True))
        assert got == [(p.begin, p.end) for p in proto.pieces], t


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
def test_normalisation_equals_the_library_with_compiled_maps(rule):
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(sentencepiece_codec._fields(dict(sentencepiece_codec._fields(library.serialized_model_proto()))[3]))
    own = sentencepiece_codec.Normaliser(spec[2], bool(spec.get(3, 1)), bool(spec.get(4, 1)), bool(spec.get(5, 1)))
    for t in TEXTS:
        want, offsets = library.normalize(t, with_offsets=True)
        got, source = own(t.encode())
        assert got.decode() == want, (rule, t)
        assert len(source) == len(got) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(t.encode())


def test_encoding_and_decoding_equal_the_library(spark, model):
    rows = [*((i, t, "s") for i, t in enumerate(TEXTS)), (50, None, "s"), (None, "x y", None), (1, TEXTS[1], "s"), (60, "ab ünï 日本 " * 40000, "s")]
    own = sentencepiece_codec.Codec(model).processor
    sha = lambda s: hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()
    want = []
    for i, t, _ in rows:
        ids, pieces = own.encode(t or ""), own.encode(t or "", return_type="proto").pieces
        spans = b"".join(x.to_bytes(4, "little") for p in pieces for x in (p.begin, p.end))
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(spans), sha(own.decode(ids))))
    want.sort(key=str)
    assert sorted(map(tuple, sentencepiece_codec.digests(docs_of(spark, rows), model).collect()), key=str) == want
    encoded = sentencepiece_codec.encode(docs_of(spark, rows), model)
    decoded = sentencepiece_codec.decode(encoded, model)
    assert sorted((r["doc_id"], sha(r["text"])) for r in decoded.collect() if r["doc_id"] is not None) == sorted((w[0], w[4]) for w in want if w[0] is not None)
    for r in encoded.where("doc_id = 4").collect():
        assert r["starts"][0] == 0 and r["ends"][-1] == len(TEXTS[4].encode())
    assert sentencepiece_codec.digests(docs_of(spark, []), model).collect() == []


def test_the_query_goes_through_spans_and_decoding(model, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["Hello  world", None]})
    seen, spans = [], sentencepiece_codec.Codec.spans
    monkeypatch.setattr(sentencepiece_codec.Codec, "spans", lambda self, text, ids: seen.append(text) or spans(self, text, ids))
    (out,) = sentencepiece_codec._digested(sentencepiece_codec._decoded(sentencepiece_codec._encoded([batch], model), model))
    assert seen == ["Hello  world", ""] and out["n_tokens"].to_pylist() == [3, 0]


# --- rules -------------------------------------------------------------------------------------------------------------


def brute_rules(rows):
    normal = lambda x: x.strip(" \t\n\x0b\x0c\r").lower().translate({ord(c): "0" for c in "123456789"})
    holders = defaultdict(set)
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            if WORD.search(line):
                holders[s, normal(line)].add(i)
    out = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        wins = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        many = Counter(wins)
        rep = {k + j for k, x in enumerate(wins) if many[x] > 1 for j in range(8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        lost = sum(len(WORD.findall(x)) for x in t.split("\n") if len(holders[s, normal(x)]) > 20)
        failed = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), failed, not failed and len(w) - lost >= 20 and len(w) - lost >= 0.3 * len(w)))
    return sorted(out, key=str)


def test_rules_equal_brute_force(spark):
    r = random.Random(6)
    common = prose(r, 30)
    rows = [(i, "\n".join([prose(r, 15), common.upper() if i % 2 else common, f"page {i % 10} # of <b>"] if i < 40 else [prose(r, 40)]), ["a", "b", None][i % 3]) for i in range(120)]
    rows += [(i + 120, common, "a") for i in range(30)] + [(i + 150, f"{common}\n{prose(r, 2)}", "b") for i in range(30)]
    rows += [(200, None, "a"), (201, "", None), (202, (prose(r, 9) + "\n") * 4, "a"), (203, "é\xa0ü " * 30, "a"), (3, rows[3][1], rows[3][2]), (None, rows[4][1], "a"), (204, prose(r, 20000), "b")]
    got = sorted(map(tuple, rules.judge(docs_of(spark, rows)).collect()), key=str)
    assert got == brute_rules(rows)
    assert {g[7] for g in got} == {True, False}
    assert rules.judge(docs_of(spark, [])).collect() == []


def test_a_notice_counts_each_document_that_holds_it(spark):
    r = random.Random(16)
    page = prose(r, 30) + "\n" + prose(r, 30)
    rows = [*((i, page, "a") for i in range(21)), *((i, page, "b") for i in range(30, 50)), *((60, page, "c") for _ in range(40))]
    got = {x["doc_id"]: x["kept"] for x in rules.judge(docs_of(spark, rows)).collect()}
    assert got == {i: s != "a" for i, _, s in rows}


# --- mixing ------------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    w = dict(zip(sorted(sizes, key=lambda s: (s is None, (s or "").encode())), [5.0, 2.0, 1.0] * 40, strict=False))
    total, target, free = 1.5 * sum(sizes.values()), {}, set(sizes)
    while free:
        rest = total - sum(target.values())
        level = rest / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * sizes[s] + 1e-9}
        if not over:
            return target | {s: level * w[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_water_filled_targets(spark, seed):
    r = random.Random(seed)
    rows = [(i, prose(r, int(r.paretovariate(1.1)) * 3), r.choice(["a", "b", "é", "😀", "￿", None])) for i in range(300)]
    rows += [(300, None, "empty"), (301, "", "a"), (302, " \t", "a"), (5, rows[5][1], rows[5][2]), (None, "u v w", "b")]
    out = mixing.taken(docs_of(spark, rows)).collect()
    again = mixing.taken(docs_of(spark, rows).repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(rows)
    sizes, by = Counter(), {}
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    for s, n in sizes.items():
        mine = [x for x in out if x["source_size"] == n and abs(x["target"] - want[s]) < 1e-6]
        assert mine, s
        by[s] = mine
    for x in out:
        assert 0 <= x["taken"] <= 2 * x["size"]
    total = sum(x["taken"] for x in out)
    assert abs(total - sum(want.values())) <= len(sizes)


def test_materialised_mix_is_what_was_taken(spark):
    r = random.Random(9)
    rows = [(i, f" {prose(r, r.randint(1, 60))}\n", r.choice("abc")) for i in range(90)] + [(90, None, "a"), (91, "", None)]
    docs = docs_of(spark, rows).withColumn("size", pa_lit()).withColumn("target", pa_lit())
    want = {x["doc_id"]: x["taken"] for x in mixing.taken(docs_of(spark, rows)).collect() if x["taken"]}
    out = mixing.materialise(docs)
    assert out.columns == docs.columns
    got, text = Counter(), {i: t for i, t, _ in rows}
    for x in out.collect():
        got[x["doc_id"]] += len(WORD.findall(x["text"]))
        assert text[x["doc_id"]].startswith(x["text"]) and x["n_chars"] == len(x["text"])
    assert got == want
    assert mixing.materialise(docs.limit(0)).collect() == [] and mixing.taken(docs_of(spark, [])).collect() == []


# --- WARC --------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("least", [0, 5])
def test_archives_read_back(spark, least, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n<p>é😀</p>"
    rows = [(5, "http://x/1", tricky), (3, None, tricky), (9, "u\r\nv", None), (8, "u", ""), (1, "u", "once"), (2, "u", "abc"), (4, "u", "abc"), (None, "u", tricky), (7, "u", "z" * 300000)]
    rows += [(100 + i, f"http://h/{i}", "same page") for i in range(500)]
    pages = spark.createDataFrame([(*x, 1) for x in rows], "page_id long, url string, html string, digest int")
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        first[b] = min(first.get(b, 10**9), 10**9 if i is None else i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = i != first[b] and len(b) >= least and Counter((x[2] or "") for x in rows)[h or ""] > 1
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", first[b] if revisit else None))
    assert sorted(map(str, map(tuple, warc.archive_and_read(pages, least).collect()))) == sorted(map(str, want))
    path = str(tmp_path / "w")
    warc.write(pages, f"file://{path}", least, file_bytes=2000)
    files = [p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*"))]
    found = [x for f in files for x in warc.records(f)]
    assert len(found) == len(rows) and {x[0]["warc-type"] for x in found} == {"revisit", "response"}
    assert all(x[1].partition(b"\r\n\r\n")[2] == b"" for x in found if x[0]["warc-type"] == "revisit")
    assert len(files) > 8 and all(len(f) < 4000 for f in files)
    # each member is a record, and the archive is what other readers of gzip see
    for f in files:
        inner = list(warc.records(gzip.decompress(f)))
        assert inner == list(warc.records(f)) == list(warc.records(gzip.compress(gzip.decompress(f))))
        assert f.count(b"\x1f\x8b\x08") >= len(inner) + 1
    assert warc.archive_and_read(pages.limit(0)).collect() == []


def test_archives_hold_fresh_headers_in_utc(spark, tmp_path):
    pages = spark.createDataFrame([(2, "http://first", "same"), (7, "http://later", "same")], "page_id long, url string, html string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        warc.write(pages, f"file://{tmp_path}/w")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    found = {x[0]["warc-record-id"]: x[0] for p in (tmp_path / "w").glob("part-*") for x in warc.records(p.read_bytes())}
    revisit = found["<urn:x-page:7>"]
    date = datetime.datetime.strptime(revisit["warc-date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=datetime.UTC)
    assert abs((datetime.datetime.now(datetime.UTC) - date).total_seconds()) < 300
    assert revisit["warc-refers-to-target-uri"] == "http://first" and revisit["warc-refers-to-date"] == found["<urn:x-page:2>"]["warc-date"]
    assert "warc-refers-to-date" not in found["<urn:x-page:2>"]


def test_damaged_archives_are_refused():
    whole = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    assert [b for _, b in warc.records(whole * 2)] == [b"hello"] * 2
    for broken in (whole[:-6], whole[:10], gzip.compress(whole)[:-9], whole + b"junk\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records(broken))


# --- search ------------------------------------------------------------------------------------------------------------


def brute_search(rows, k=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            s = (x * v).sum(1)
            order = sorted(((-a, j) for a, j in zip(s, ids.tolist(), strict=True) if j != i))[:k]
            out[i] = [(j, -a) for a, j in order]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_search_recall_and_order(spark, monkeypatch, small):
    if small:  # several functions, a sample smaller than the table, blocks of vectors and of queries
        for name, value in {"PER_BUCKET": 8, "SAMPLE": 200, "BLOCK": 16, "ASKING": 4, "PROBES": 4}.items():
            monkeypatch.setattr(multiprobe, name, value)
    out = queries.op4_multiprobe_search(spark, DATA).toPandas()
    e = spark.read.parquet(f"{DATA}/embeddings.parquet").toPandas()
    want = brute_search([(int(i), np.asarray(v, float)) for i, v in zip(e.vec_id, e.embedding, strict=True)])
    hits = 0
    for q, g in out.sort_values("rank").groupby("query_id"):
        assert list(g["rank"]) == list(range(1, 21)) and g.score.is_monotonic_decreasing
        hits += len(set(g.vec_id) & {j for j, _ in want[q]})
    assert set(out.query_id) == set(want) and hits / 20 / len(want) >= 0.9


def test_search_visits_the_likeliest_buckets():
    r = np.random.default_rng(0)
    for functions in (1, 3, 4):
        plan = multiprobe.Plan(r.normal(size=(4, functions, 9)), r.normal(size=(4, functions)), 1.0, 9.0, 2.0, 7, np.zeros(0))
        x = r.normal(size=(30, 8))
        plan.sizes = r.integers(0, 3, (4, plan.buckets)) * (r.random((4, plan.buckets)) < 0.2)
        order, want = plan.order(x, plan.buckets), set()
        assert (np.sort(order, -1) == np.arange(plan.buckets)).all()
        for t in range(4):
            for i in range(30):
                met = 0
                for n, b in enumerate(order[t, i]):
                    if (n < 7 or met <= 20) and plan.sizes[t, b]:
                        want.add((t, i, int(b)))
                    met += plan.sizes[t, b]
        got = [(t, int(i), int(b)) for t, rows, buckets, _ in plan.visits(x, 20) for i, b in zip(rows, buckets, strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_search_with_copies_ties_and_unusable_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(a) for a in np.round(r.normal(0, 3, 4))]) for i in range(1, 90)]
    rows = [(i, v) for i, v in rows if any(v)] + [(i, [1.0, 2.0, 0.0, -1.0]) for i in range(100, 400)]
    bad = [(400, None), (401, [0.0] * 4), (402, [1.0, None, 0.0, 0.0]), (403, [float("nan")] * 4), (404, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (rows[0][0], rows[0][1])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in [*rows, *bad]], "vec_id long, embedding array<double>, rank int")
    got = defaultdict(list)
    for x in multiprobe.search(vectors).orderBy("query_id", "rank").collect():
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    want = brute_search([(i, np.array(v)) for i, v in rows])
    assert set(got) == set(want)
    exact = sum(g == want[q] for q, g in got.items())
    assert exact >= 0.9 * len(want) and all(len(g) == 20 for g in got.values())
    few = spark.createDataFrame([(20, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0]), (40, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(x) for x in multiprobe.search(few).where("query_id = 20").orderBy("rank").collect()] == [(20, 1, 2, 2.0), (20, 2, 1, 1.0), (20, 3, 40, 0.0)]
    assert multiprobe.search(few.limit(0)).collect() == []


# --- the pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark, model):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA).persist()
        seen.append((docs.count(), docs.columns))
    own = spark.read.parquet(f"{DATA}/documents.parquet").columns
    assert all(c == own for _, c in seen[:4]) and seen[4][1] == ["doc_id", "n_tokens", "ids_sha256", "spans_sha256", "decoded_sha256"]
    assert 1000 > seen[0][0] == seen[1][0] > seen[2][0] and seen[3][0] == seen[4][0]
    assert docs.select("doc_id").distinct().count() <= seen[2][0]
