"""The core operators against plain Python, on hand-made rows."""

import gzip
import json
import math
import random
import sys

import pytest
from pyspark.sql import functions as F

from gristmill.functions import text as X
from gristmill.functions import tools, variant
from gristmill.operators import adapters, filters, mcq, param_pool, pretty, sampling
from gristmill.plans.pipeline import Options, postprocess, run
from gristmill.sources import config, readers, sinks

SPACES = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]


def one(spark, rows, *columns, schema="s string"):
    return [r[0] if len(columns) == 1 else tuple(r) for r in spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i long, {schema}").orderBy("i").select(*columns).collect()]


# --- helpers: H1 to H8 -----------------------------------------------------------------------------------------------


def test_strip_knows_every_blank(spark):
    texts = [c + "a" + c + "b" + c for c in SPACES] + ["", " ", "\n\na\n", "​a", "a\n"]
    assert one(spark, texts, X.strip(F.col("s"))) == [t.strip() for t in texts]
    assert one(spark, [None, " a "], X.ensure_text(F.col("s"))) == ["", "a"]


def test_lines_break_where_python_breaks_them(spark):
    breaks = [c for c in map(chr, range(0x3000)) if len(f"a{c}b".splitlines()) == 2]
    texts = ["", "a", "a\n", "\n", "a\r\nb\r", "a\n\rb"] + [f"a{c}b{c}" for c in breaks]
    assert one(spark, texts, X.lines_of(F.col("s"))) == [t.splitlines() for t in texts]
    assert one(spark, texts, F.size(X.words_of(F.col("s")))) == [len(t.split()) for t in texts]


def test_tokens_ids_and_hashes(spark):
    import hashlib

    texts = ["", "abc", "abcd", "x" * 9, None, "é😀" * 7]
    for cpt in (4.0, 2.5, 0):
        want = [0 if not t else max(1, int(len(t) / max(cpt, 1e-6))) for t in texts]
        assert one(spark, texts, X.est_tokens(F.col("s"), cpt)) == want
    ids = ["a", "é", "doc/1", ""]
    assert one(spark, ids, X.stable_u(F.col("s"))) == [int.from_bytes(hashlib.sha1(i.encode()).digest()[:8], "big") / 2**64 for i in ids]
    assert one(spark, [("f", 3)], X.path_id(F.col("s"), F.col("n")), schema="s string, n int") == ["f/3"]
    assert one(spark, [(None, "", "c"), ("a", "b", "c")], X.first_truthy(F.col("a"), F.col("b"), F.col("c")), schema="a string, b string, c string") == ["c", "a"]
    assert X.slug("a/b\\c..d e") == "a__b__c_d_e" and len(X.slug("x" * 300)) == 180
    assert one(spark, ["p <|a|>q<|b c|>"], tools.role_tags(F.col("s"))) == [["a", "b c"]]


def test_json_is_strict_and_shown_with_blanks(spark):
    good = ['{"b": [1, "x,:\\"y"], "a": {"c": null}}', "[]", '"s"', " 7 ", "true", '{"é": "ü"}']
    bad = ["", "{bad", '{"a": 1}}', "1, 2", "1] [2", '{"a": 1} {"b": 2}', "NaN", None]
    v = variant.parse_json(F.col("s"))
    assert one(spark, bad, v.isNull()) == [True] * len(bad)
    assert one(spark, good, variant.display(v)) == [json.dumps(json.loads(g), ensure_ascii=False, sort_keys=True) for g in good]
    assert one(spark, ['{"id": 123}', '{"id": "x"}', "{}", '{"id": null}'], variant.as_string(variant.member(v, "id"))) == [None, "x", None, None]
    assert one(spark, ['{"id": null}', "{}"], variant.member(v, "id").isNotNull()) == [True, False]


# --- sources: S1 to S22 ----------------------------------------------------------------------------------------------


def read_all(df):
    return [(r["pos"], json.loads(r["raw"])) for r in df.select("pos", F.to_json("raw").alias("raw")).orderBy("pos").collect()]


def test_messy_lines(spark, tmp_path):
    p = tmp_path / "messy.jsonl"
    p.write_text('{"a": 1}\n\nnull\n[1, 2]\n[{"a": 1}]\n"str"\n7\n{bad\n{"b": 2}\n')
    want = [(0, {"a": 1}), (3, {"value": [1, 2]}), (4, {"value": [{"a": 1}]}), (5, {"value": "str"}), (6, {"value": 7}), (8, {"b": 2})]
    assert read_all(readers.read_jsonl(spark, [str(p)])) == want
    assert {r["status"]: r["count"] for r in readers.line_report(spark, [str(p)]).collect()} == {"ok": 6, "blank": 1, "null": 1, "bad": 1}


def test_positions_across_blocks_and_files(spark, tmp_path):
    for name, n in (("a", 3000), ("b", 1), ("c", 1700)):
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"f": name, "n": i, "x": "y" * (i % 50)}) + "\n" for i in range(n)))
    with gzip.open(tmp_path / "d.jsonl.gz", "wt") as f:
        f.write('{"f": "d", "n": 0}\n{"f": "d", "n": 1}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = readers.read(spark, "jsonl", sorted(map(str, tmp_path.iterdir()))).select("pos", F.to_json("raw").alias("raw")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 4703 and all(json.loads(r["raw"])["n"] == r["pos"] for r in rows)


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_array_items_come_in_pieces(size):
    def items(text):
        got = []
        try:
            for x in readers.array_items(text[i : i + size] for i in range(0, len(text), size)):
                got.append(x)
        except ValueError:
            got.append("fault")
        return got

    assert items(' [{"a": 1},, 5 , "x]",-1.5e3] rest') == [{"a": 1}, 5, "x]", -1500.0]
    assert items("") == [] and items("[]") == []
    assert items('{"a": 1}') == ["fault"] and items('[{"a": 1}, {"a"') == [{"a": 1}, "fault"]


def test_array_parquet_and_csv_files(spark, tmp_path):
    for name, text in (("ok", '[{"a":1},\n 5, null, {"a":2}]'), ("not", '{"a": 1}'), ("cut", '[{"a": 9}, {"a"')):
        (tmp_path / f"{name}.json").write_text(text)
    assert read_all(readers.read_json_array(spark, [str(tmp_path / "ok.json")])) == [(0, {"a": 1}), (1, {"value": 5}), (2, {"value": None}), (3, {"a": 2})]
    assert read_all(readers.read_json_array(spark, [str(tmp_path / "not.json")])) == []
    assert read_all(readers.read_json_array(spark, [str(tmp_path / "cut.json")])) == [(0, {"a": 9})]
    spark.createDataFrame([("i1", "t1"), ("i2", None)], "id string, text string").coalesce(1).write.parquet(str(tmp_path / "p"))
    assert [r[1].get("text") for r in read_all(readers.read_parquet(spark, [str(tmp_path / "p")]))] == ["t1", None]
    (tmp_path / "x.csv").write_text("id,text\n7,hello\n8,\n")
    assert [r[1]["id"] for r in read_all(readers.read_csv(spark, [str(tmp_path / "x.csv")]))] == ["7", "8"]
    with pytest.raises(ValueError, match="unknown source type"):
        readers.read(spark, "xml", [])


def test_configs_choose_files(tmp_path):
    data, conf = tmp_path / "data", tmp_path / "conf"
    for f in ("tree/high/p1.jsonl", "tree/low/p2.jsonl", "tree/high/p3.jsonl"):
        (data / f).parent.mkdir(parents=True, exist_ok=True)
        (data / f).write_text("{}\n")
    (data / "tree/high/lfs.jsonl").write_text("version https://git-lfs.github.com/spec/v1\noid x\n")
    conf.mkdir()
    source = {"type": "jsonl", "data_dir": "tree", "globs": ["**/*.jsonl", "high/*.jsonl"], "path_keywords": ["high"]}
    for n, enabled in enumerate((True, False, None, "true")):
        cfg = {"dataset": {"name": f"d{n}"}, "sources": [{"type": "jsonl", "data_dir": "gone", "glob": "*"}, source], "adapter": {"kind": "glaive"}, "executor": {"token_billions": [0.001, "x", None, 0][n]}}
        if enabled is not None:
            cfg["enabled"] = enabled
        (conf / f"c{n}.json").write_text(json.dumps(cfg))
    found = config.load_configs(str(conf))
    assert [d.enabled for d in found] == [True, False, True, False]
    assert [d.token_budget for d in found] == [1_000_000, 0, 0, 0]
    assert config.pick_source(found[0], str(data)) == source
    with pytest.warns(UserWarning, match="LFS"):
        files = config.source_files(source, str(data))
    assert [f.rsplit("/", 1)[1] for f in files] == ["p1.jsonl", "p3.jsonl"]
    assert config.file_stats(files) == (2, 6)
    assert config.sample_probability(10, 400, 4.0) == 0.1 and config.sample_probability(0, 5) == 1.0
    assert sampling.shuffled_files(files, "s") == sampling.shuffled_files(files[::-1], "s")
    (conf / "bad.json").write_text("{")
    with pytest.raises(ValueError):
        config.load_configs(str(conf))


# --- adapters: A1 to A20 ---------------------------------------------------------------------------------------------


def adapted(spark, kind, rows, **how):
    df = spark.createDataFrame([("f", i, json.dumps(r)) for i, r in enumerate(rows)], "file string, pos long, j string").select("file", "pos", F.parse_json("j").alias("raw"))
    return {r["id"]: r["text"] for r in adapters.adapt(df, kind, "ds", **how).collect()}


def test_toucan(spark):
    call = {"name": "f", "arguments": {"b": 1, "a": "x"}}
    rows = [
        {"uuid": "u1", "messages": [{"role": "user", "content": " hi "}, {"role": "assistant", "content": "", "function_call": call}, {"role": "function", "content": "r"}]},
        {"messages": json.dumps([{"role": "tool", "content": "both", "function_call": call}, 5, {"content": "bare"}])},
        {"uuid": "u3", "messages": "not json", "question": " q "},
        {"uuid": "u4", "messages": [{"function_call": {"a": 1, "b": 2}}, {"function_call": {"b": 2, "a": 1}}]},
        {"uuid": "u5", "messages": []},
        {"uuid": 6, "messages": [{"role": "user", "content": 7, "function_call": "g()"}]},
    ]
    got = adapted(spark, "toucan", rows)
    shown = '<|tool_call|>\n{"arguments": {"a": "x", "b": 1}, "name": "f"}\n</|tool_call|>'
    assert got == {
        "u1": f"<|user|>\nhi\n\n{shown}\n\n<|tool_output|>\nr",
        "f/1": "<|tool|>\nboth\n\n<|tool_output|>\nboth\n\nbare",
        "u3": "q",
        "f/5": "<|tool_call|>\ng()\n</|tool_call|>",
    }


def test_agent_data(spark):
    rows = [
        {"id": "c", "conversations": [{"role": "Human ", "content": "a"}, {"from": "gpt", "value": {"k": [1]}}, {"speaker": "weird", "text": "b"}, {"content": None, "value": "hidden"}, {"text": "bare"}, 3]},
        {"id": "m", "conversations": [], "messages": [{"name": "system", "content": "s"}, {"role": "thought", "content": "t"}, {"role": "action", "content": "x"}]},
        {"id": "s", "content": [{"source": "code_action", "content": "run", "description": "why"}, {"class_": "text_observation", "content": "out", "description": "about"}, {"description": "only"}]},
        {"id": "p", "question": " ", "prompt": 5, "instruction": " do "},
        {"id": "", "input": "last"},
        {"id": "none"},
    ]
    assert adapted(spark, "agent-data-collection", rows) == {
        "c": '<|user|>\na\n\n<|assistant|>\n{"k": [1]}\n\n<|assistant|>\nb\n\nbare',
        "m": "<|system|>\ns\n\n<|assistant|>\n<think>\nt\n</think>\n\n<|assistant|>\n<|tool_call|>\nx\n</|tool_call|>",
        "s": "<|assistant|>\n<think>\nwhy\n</think>\n\n<|assistant|>\n<|tool_call|>\nrun\n</|tool_call|>\n\n<|tool|>\nout\n\n<|assistant|>\nabout\n\n<|assistant|>\nonly",
        "p": "do",
        "f/4": "last",
    }


def test_the_other_adapters(spark):
    assert adapted(spark, "glaive", [{"system": "s", "chat": "c "}, {"chat": "c"}, {"system": 5}]) == {"f/0": "s\n\nc", "f/1": "c"}
    rows = [
        {"id": "t", "text": " Task: do\n\nAction: a\nAction: b Agent. "},
        {"id": "l", "text": "before\nUSER : hi more\r\nassistant:\nx\nUser:"},
        {"id": "n", "text": "no roles\nuser says: x"},
        {"id": 5, "text": 5},
    ]
    assert adapted(spark, "hephaestus", rows) == {
        "t": "<|user|>\nTask: do\n\n<|assistant|>\nAction:\na\nAction: b Agent.",
        "l": "<|user|>\nhi\nmore\n\n<|assistant|>\nx\n\n<|user|>",
        "n": "no roles\nuser says: x",
    }
    rows = [{"uuid": "m", "messages": [{"role": "user", "content": "q", "reasoning_content": "no"}, {"role": " assistant ", "content": "a", "reasoning_content": " r "}, {"content": "x"}, 1]}, {"uuid": "o", "messages": "x"}]
    assert adapted(spark, "nemotron-math-v2", rows) == {"m": "user\nq\nassistant\nr\na\nx"}
    assert adapted(spark, "nemotron-pretraining-sft-v1", [{"id": "i", "text": " t "}, {"id": 7, "text": "u"}, {"id": "z", "text": 9}]) == {"i": "t", "f/1": "u"}
    with pytest.raises(ValueError, match="unknown adapter"):
        adapted(spark, "nope", [])


def test_system_mixin_and_metadata(spark):
    rows = [{"id": f"i{n}", "text": "t", "system": [" s ", " ", None, 4][n % 4]} for n in range(40)]
    for ratio in (0, 0.5, 1, -1, 2):
        got = adapted(spark, "nemotron-pretraining-sft-v1", rows, system_ratio=ratio)
        import hashlib

        u = {f"i{n}": int.from_bytes(hashlib.sha1(f"i{n}".encode()).digest()[:8], "big") / 2**64 for n in range(40)}
        assert got == {f"i{n}": "SYSTEM:\ns\n\nt" if n % 4 == 0 and u[f"i{n}"] < min(1, max(0, ratio)) else "t" for n in range(40)}
    df = spark.createDataFrame([("f", 0, '{"id": "a", "text": "b"}')], "file string, pos long, j string").select("file", "pos", F.parse_json("j").alias("raw"))
    docs = adapters.adapt(df, "nemotron-pretraining-sft-v1", "ds", "conf.json", with_raw=True)
    r = docs.select("metadata.dataset", "metadata._config", F.to_json("metadata.raw")).first()
    assert tuple(r) == ("ds", "conf.json", '{"id":"a","text":"b"}')
    assert tuple(adapters.prepare(docs, mixed=True).first()) == ("ds::a", "b")


# --- exclusion -------------------------------------------------------------------------------------------------------


def test_blacklists(spark, tmp_path):
    d = tmp_path / "deep" / "er"
    d.mkdir(parents=True)
    (tmp_path / "p.jsonl").write_text('{"uuid":"u1","text":"x"}\n{"id":"i1"}\n{"doc_id":"d1"}\n{"uuid":"","id":"i2"}\n x1 \n{"id":"a\\"b"}\n\n{"id":5}\n{"m":{"id":"nested"}}\n"quoted"\n')
    with gzip.open(d / "z.jsonl.gz", "wt") as f:
        f.write('{"id":"gz"}\n')
    (d / "list.txt").write_text('plain\n{"id":"whole line"}\n\n')
    common = {"u1", "i1", "d1", "i2", "x1", 'a"b', "gz", "plain", '{"id":"whole line"}'}
    assert {r[0] for r in filters.load_blacklist(spark, str(tmp_path)).collect()} == common | {"5", "quoted"}
    assert {r[0] for r in filters.load_blacklist(spark, str(tmp_path), compat=True).collect()} == common | {"nested", '"quoted"'}


def test_exclusion_keeps_repeats_and_empty_ids(spark):
    docs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("", "e"), ("c", "w")], "id string, text string").withColumn("metadata", F.struct(F.lit("ds").alias("dataset")))
    listed = spark.createDataFrame([("b",), ("",), ("ds::c",), (None,)], "id string")
    assert sorted(r["text"] for r in filters.exclude_ids(docs, listed).collect()) == ["e", "w", "x", "y"]
    assert sorted(r["text"] for r in filters.exclude_ids(docs, listed, mixed=True).collect()) == ["e", "x", "y"]
    assert filters.exclude_ids(docs, listed.limit(0)).count() == 5


# --- budgets ---------------------------------------------------------------------------------------------------------


def brute_budget(tokens, budget):
    out, total = [], 0
    for i, t in enumerate(tokens):
        if i and total + t > budget:
            break
        out.append(i)
        total += t
        if total >= budget:
            break
    return out


@pytest.mark.parametrize(("tokens", "budget"), [([50, 10, 10], 20), ([10, 10, 10], 20), ([10, 15, 5], 20), ([random.Random(1).randint(1, 30) for _ in range(500)], 3000)])
def test_budget_is_a_prefix(spark, tokens, budget):
    docs = spark.createDataFrame(list(enumerate(tokens)), "i long, tokens long").repartition(5)
    assert sorted(r["i"] for r in sampling.token_budget(docs, budget, [F.col("i")]).collect()) == brute_budget(tokens, budget)
    got = sampling.token_budget(docs, budget, [F.col("i")], "rank", 3).collect()
    for rank in range(3):
        mine = tokens[rank::3]
        assert sorted(r["i"] for r in got if r["rank"] == rank) == [rank + 3 * k for k in brute_budget(mine, math.ceil(budget / 3))]


def test_samples_and_positions(spark):
    rows = spark.range(1000).withColumn("k", F.col("id").cast("string"))
    a = {r["id"] for r in sampling.hash_sample(rows, 0.3, F.col("k"), "s").collect()}
    assert 230 < len(a) < 370 and a == {r["id"] for r in sampling.hash_sample(rows.repartition(3), 0.3, F.col("k"), "s").collect()}
    assert sampling.hash_sample(rows, 1.0, F.col("k")).count() == 1000 and sampling.hash_sample(rows, 0, F.col("k")).count() == 0
    assert [r["id"] for r in filters.every_n(spark.range(11), 5, F.col("id")).orderBy("id").collect()] == [0, 5, 10]


# --- tools, pool and questions -----------------------------------------------------------------------------------------

SPECS = [
    {"type": "function", "function": {"name": "f", "description": " does f ", "parameters": {"required": ["a", 1, 2.5], "properties": {"a": {"type": "integer"}, "b": {"type": "string"}}}}},
    {"name": "g", "description": " plain "},
    {"function": {"name": "h", "parameters": {"required": "no"}}},
]


def test_specs_and_calls(spark):
    texts = [f"x<tools>\n{json.dumps(SPECS)}\n</tools>y", "<tools>" + "\n".join(map(json.dumps, SPECS)) + "\nbad\n5\n</tools>", "<tools>[]</tools>", "</tools><tools>", "none"]
    names = F.transform(tools.tool_specs(F.col("s")), tools.tool_name)
    assert one(spark, texts, names) == [["f", "g", "h"]] * 2 + [[]] * 3
    assert one(spark, texts[:1], F.transform(tools.tool_specs(F.col("s")), tools.required_params)) == [[["a", "1"], [], []]]
    assert one(spark, texts[:1], F.transform(tools.tool_specs(F.col("s")), tools.tool_description)) == [["does f", " plain ", ""]]
    payloads = ['{"name": "f", "arguments": {"a": 1}}', '{"name": "f", "arguments": "{\\"a\\": 1}"}', "{'name': 'f', 'arguments': {'a': 1}}", "[1]", "", '{"arguments": [1]}', '{"arguments": "x"}']
    assert one(spark, payloads, F.to_json(tools.call_args(tools.parse_call(F.col("s"))))) == ['{"a":1}'] * 3 + [None] * 4
    text = "".join(f"<|tool_call|>{p}</|tool_call|>\n" for p in (payloads[0], "bad", '{"name": "g"}', payloads[0], '{"name": 5}')) + "<|tool_call|>" + payloads[0]
    assert one(spark, [text, ""], tools.call_names(F.col("s"))) == [["f", "g"], []]


def test_types_and_clusters(spark):
    cases = {
        "true": ("boolean", "boolean"), "0": ("integer", "number:zero:single_digit"), "-12": ("integer", "number:negative:two_digits"), "12345": ("integer", "number:positive:eight_digits"),
        "123456789": ("integer", "number:positive:huge"), "0.5": ("number", "number:fraction"), "5.25": ("number", "number:small"), "50.5": ("number", "number:medium"), "5000.5": ("number", "number:huge"),
        "[]": ("array", "array"), "{}": ("object", "object"), "null": ("unknown", "unknown"), '"http://x"': ("string", "string:url"), '"a/b"': ("string", "string:path_or_uri"),
        '"one two three four five six"': ("string", "string:long_text"), '"123"': ("string", "string:numeric"), '"ab1"': ("string", "string:alnum"), '"abc"': ("string", "string:general"), '"²"': ("string", "string:numeric"),
    }
    v = variant.parse_json(F.col("s"))
    assert one(spark, list(cases), tools.value_type(v), tools.cluster_label(tools.value_type(v), v)) == list(cases.values())
    odd = [("true", "integer"), ('"x"', "integer"), ("5", "string"), ("5", "whatever")]
    assert one(spark, odd, tools.cluster_label(F.col("t"), v), schema="s string, t string") == ["number:positive:single_digit", "number:other", "string:non_str", "unknown"]


def call_text(name, args):
    return f"<|tool_call|>\n{json.dumps({'name': name, 'arguments': args})}\n</|tool_call|>"


def pool_docs(spark):
    rows = [(f"{i:03d}", "<tools>" + json.dumps(SPECS) + "</tools>" + call_text("f", {"a": i % 13, "b": f"v{i}"}) + call_text("g", {"a": "s"})) for i in range(40)]
    return spark.createDataFrame(rows, "uuid string, text string"), rows


def test_pool(spark):
    docs, _ = pool_docs(spark)
    pool = {(r["level"], r["func"], r["param"], r["p_type"], r["cluster"]): r for r in param_pool.pool_from_texts(docs, max_values=10).collect()}
    fb = pool["function", "f", "b", "string", "string:alnum"]
    assert (fb["observed"], fb["count"], fb["values"]) == (40, 40, [f'"v{i}"' for i in range(10)])
    assert pool["function", "f", "a", "integer", "number:positive:single_digit"]["values"] == [str(i) for i in range(1, 10)]
    assert pool["param", None, "a", "integer", "string:general"]["count"] == 40 and pool["param", None, "a", "integer", "string:general"]["observed"] == 80
    assert pool["type", None, None, "string", "string:alnum"]["observed"] == 80
    full = param_pool.pool_from_texts(docs)
    nested = json.loads(param_pool.to_json(full))
    assert nested["functions"]["g"]["params"]["a"] == {"type": "string", "required": False, "observed": 40, "clusters": {"string:general": {"count": 40, "values": ["s"]}}}
    back = param_pool.from_json(spark, json.dumps(nested))
    assert back.count() == full.count()
    assert param_pool.from_json(spark, "nonsense{").count() == param_pool.from_json(spark, None).count() == 0


@pytest.mark.parametrize("prefer", [False, True])
def test_questions(spark, prefer):
    import re

    docs, rows = pool_docs(spark)
    extra = [("none", "no calls"), ("open", call_text("f", {"a": 1}) + "<|tool_call|>open"), ("bad", "<|tool_call|>bad</|tool_call|>tail"), ("one", call_text("only", {"zz": [1]}))]
    docs = docs.union(spark.createDataFrame(extra, "uuid string, text string"))
    out = {r["uuid"]: r["text"] for r in mcq.augment(docs, pool=param_pool.pool_from_texts(docs), prefer_values=prefer).collect()}
    again = {r["uuid"]: r["text"] for r in mcq.augment(docs.repartition(3), pool=param_pool.pool_from_texts(docs), prefer_values=prefer).collect()}
    assert out == again and set(out) == {u for u, _ in rows + extra}
    for u, before in rows + extra:
        assert re.sub(r"(?s)<\|(mcq_\w+)\|>.*?</\|\1\|>", "", out[u]) == before
    for u, before in rows:
        asked = re.findall(r"(?s)<\|(mcq_\w+)\|>\n(.*?)\n</\|", out[u])
        assert [k for k, _ in asked] == (["mcq_tool", "mcq_param_values", "mcq_tool", "mcq_param_values"] if prefer else ["mcq_tool", "mcq_params", "mcq_param_values", "mcq_tool", "mcq_param_values"])
        right = {"mcq_tool": {"f", "g"}, "mcq_params": {"a, 1"}, "mcq_param_values": {json.dumps(json.loads(c)["arguments"]) for c in re.findall(r"(?s)<\|tool_call\|>\n(.*?)\n</", before)}}
        for k, q in asked:
            options = dict(re.findall(r"(?m)^  ([A-D])\) (.*)$", q))
            assert 2 <= len(options) <= 4 and options[re.search(r"Answer: (\w)$", q)[1]] in right[k]
            if k != "mcq_params":
                assert len(set(options.values())) == len(options)
    assert out["none"] == "no calls" and out["bad"] == "<|tool_call|>bad</|tool_call|>tail"
    with pytest.raises(ValueError):
        mcq.augment(docs, pool=param_pool.pool_from_texts(docs), most=4)


def test_every_nth_record_is_augmented(spark):
    docs, rows = pool_docs(spark)
    placed = docs.withColumn("at", F.col("uuid").cast("long"))
    out = {r["uuid"]: r["text"] for r in mcq.augment_every(placed, 10, F.col("at")).collect()}
    assert sum(out[u] != t for u, t in rows) == 4 and len(out) == 40


# --- rendering -------------------------------------------------------------------------------------------------------


def test_blocks_and_pretty_texts(spark):
    texts = ["plain\ntext ", "lead<|user|>\na < b<|x y|><|assistant|>z", '<|tool_call|>{"b":1,"a":[1]}</|tool_call|>after <|tool_call|>open <|user|> end', "<|user|> ", " ", None]
    got = one(spark, texts, pretty.split_tagged(F.col("s")))
    assert [[tuple(b) for b in g] for g in got] == [
        [("text", "plain\ntext ")],
        [("text", "lead"), ("user", "\na < b"), ("x y", ""), ("assistant", "z")],
        [("tool_call", '{"b":1,"a":[1]}'), ("text", "after "), ("tool_call", "open <|user|> end")],
        [("user", " ")],
        [],
        [],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "uuid long, text string")
    shown = {r["uuid"]: r["pretty"] for r in pretty.pretty_blocks(docs, "uuid").collect()}
    assert shown == {0: "  plain\n  text", 1: "[text]\n  lead\n[user]\n  a < b\n[assistant]\n  z", 2: '[tool_call]\n  {\n    "b": 1,\n    "a": [\n      1\n    ]\n  }\n[text]\n  after\n[tool_call]\n  open <|user|> end', 3: "", 4: "", 5: ""}
    spec = spark.createDataFrame([("u", "<tools>" + json.dumps(SPECS) + "</tools>")], "uuid string, text string")
    assert pretty.pretty_records(spec, number=F.lit(1)).first()["record"].startswith("=== Record 1 | id=u ===\nAvailable tools:\n  - f\n    does f\n    required: a, 1\n  - g\n     plain \n  - h\nMessages:\n")
    split = pretty.classify(spark.createDataFrame([("<|user|><|assistant|>",), ("<|user|>",), (None,)], "text string"))
    assert {r["bucket"]: r["n"] for r in pretty.bucket_counts(split).collect()} == {"cpt_sft": 1, "other": 2}
    assert {r["bucket"]: r["n"] for r in pretty.bucket_counts(split.limit(0)).collect()} == {"cpt_sft": 0, "other": 0}


def plan_after(df):
    """The plan that ran, without the parts that reuse others."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_the_pool_parses_each_call_once(spark):
    docs, _ = pool_docs(spark)
    for columns in ("*", "p_type observed", "cluster count", "values"):
        assert plan_after(param_pool.pool_from_texts(docs).select(*columns.split())).count("Generate posexplode") == 1


def test_questions_about_values_stay_with_their_text(spark):
    docs, _ = pool_docs(spark)
    plan = plan_after(mcq.augment(docs, pool=param_pool.pool_from_texts(docs)))
    assert plan.count("Generate posexplode") == 1 and "SortMergeJoin [name" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 + plan.count("ReusedExchange")


def test_small_tables_of_long_work_are_dealt_to_many_tasks(spark):
    from gristmill import queries

    assert queries._tool_texts(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4
    assert queries.call_texts(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4


def test_records_need_no_shuffle_and_keep_their_own_text(spark):
    rows = [("u", "<|user|>a"), ("u", '<|tool_output|>{"b":1}'), (None, "c")]
    out = pretty.pretty_records(spark.createDataFrame(rows, "uuid string, text string"))
    assert "Exchange" not in plan_after(out)
    want = [("u", "    a"), ("u", '    {\n      "b": 1\n    }'), (None, "    c")]
    assert sorted((str(r["uuid"]), r["record"].split("Messages:\n")[1]) for r in out.collect()) == sorted((str(u), f"{h}{x}\n") for (u, x), h in zip(want, ("  [user]\n", "  [tool_output]\n", ""), strict=True))


# --- sinks and the run -------------------------------------------------------------------------------------------------


def test_questions_of_repeated_ids(spark):
    call = "<|tool_call|>{'name': '%s', 'arguments': {'x': %d}}</|tool_call|>"
    docs = spark.createDataFrame([("u", call % ("a", 1) + call % ("b", 2)), ("u", call % ("c", 3) + call % ("d", 4)), ("u", call % ("c", 3) + call % ("d", 4)), (None, call % ("a", 1))], "uuid string, text string")
    for pool in (None, param_pool.pool_from_texts(docs)):
        out = mcq.augment(docs, pool=pool)
        assert sorted(mcq_free(r["text"]) for r in out.collect()) == sorted(r["text"] for r in docs.collect())
        assert len({r["text"] for r in out.collect()}) == 3
        for r in out.where("uuid = 'u'").collect():
            assert ("B) " in r["text"]) and all((f") {n}\n" in r["text"]) == (f"'{n}'" in r["text"]) for n in "abcd")


def mcq_free(text):
    import re

    return re.sub(r"(?s)<\|(mcq_\w+)\|>.*?</\|\1\|>", "", text)


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(i, "é" * (i % 7)) for i in range(50)], "i long, t string")
    sinks.write_jsonl(docs, str(tmp_path / "a"), files=3)
    assert len(list((tmp_path / "a").glob("part-*"))) == 3
    assert sorted(json.loads(x)["i"] for p in (tmp_path / "a").glob("part-*") for x in p.read_text().splitlines()) == list(range(50))
    sinks.write_rolled(docs, str(tmp_path / "r"), 200, [F.col("i")])
    assert len(list((tmp_path / "r").glob("shard=*"))) > 3
    sinks.merge_files(spark, str(tmp_path / "a"), str(tmp_path / "m"), 1)
    assert len(list((tmp_path / "m").glob("merged=0/part-*"))) == 1
    sinks.merge_files(spark, str(tmp_path / "a"), str(tmp_path / "m"), 2)
    assert sorted(p.name for p in (tmp_path / "m").glob("merged=*")) == ["merged=0", "merged=1"]
    merged = [x for p in (tmp_path / "m").glob("merged=*/part-*") for x in p.read_text().splitlines()]
    assert sorted(json.loads(x)["i"] for x in merged) == list(range(50))
    sinks.write_rolled(docs, str(tmp_path / "q"), 200, [-F.col("i")])
    rolled = [[json.loads(x)["i"] for x in p.read_text().splitlines()] for k in range(4) for p in (tmp_path / "q").glob(f"shard={k}/part-*")]
    assert [i for x in rolled for i in x] == list(range(49, 49 - sum(map(len, rolled)), -1))
    assert sinks.lpt_bins({"a": 5, "b": 4, "c": 3, "d": 3}, 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
    sinks.write_split(docs.withColumn("bucket", F.when(F.col("i") < 5, "x").otherwise("y")), str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "s").glob("bucket=*")} == {"bucket=x", "bucket=y"}


def lines_below(path):
    return [json.loads(x) for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]


def test_a_whole_run(spark, tmp_path):
    root, conf, out, old = (tmp_path / n for n in ("root", "conf", "out", "old"))
    for d in (root / "d", conf, old):
        d.mkdir(parents=True)
    (root / "d" / "x.jsonl").write_text("".join(json.dumps({"id": f"i{n}", "text": f"text {n} " + call_text("f", {"a": n}) + call_text("g", {"b": n})}) + "\n" for n in range(30)) + "bad\n")
    (old / "p.jsonl").write_text('{"uuid": "i3"}\n{"uuid": "ds::i4"}\n')
    cfg = {"enabled": True, "dataset": {"name": "ds"}, "sources": [{"type": "jsonl", "data_dir": "d", "glob": "*.jsonl"}], "adapter": {"kind": "nemotron-pretraining-sft-v1"}, "postprocess": {"kinds": ["param_pool", "tool_mcq"], "pretty_txt": True}, "executor": {"merge_to_files": 2}}
    (conf / "c.json").write_text(json.dumps(cfg))
    assert run(spark, str(conf), str(root), str(out), Options(), str(old)) == 0
    got = lines_below(out / "prepare" / "ds")
    assert sorted(g["uuid"] for g in got) == sorted(f"i{n}" for n in range(30) if n != 3)
    assert lines_below(out / "ds")[0]["metadata"]["raw"]["id"].startswith("i")
    assert all("<|mcq_tool|>" in g["text"] for g in lines_below(out / "prepare" / "ds_post"))
    assert lines_below(out / "_stats") == [{"dataset": "ds", "docs": 29, "tokens": sum(max(1, len(g["text"]) // 4) for g in got)}]
    assert run(spark, str(conf), str(root), str(out), Options(mixed="mix", limit=-1), str(old)) == 0
    assert sorted(g["uuid"] for g in lines_below(out / "mixed" / "mix" / "ds")) == sorted(f"ds::i{n}" for n in range(30) if n not in (3, 4))
    (conf / "c.json").write_text(json.dumps(cfg | {"executor": {"token_billions": 1e-7}, "postprocess": {}}))
    assert run(spark, str(conf), str(root), str(out)) == 0
    assert 1 <= len(lines_below(out / "prepare" / "ds")) < 10
    (conf / "c.json").write_text(json.dumps(cfg | {"adapter": {"kind": "nope"}}))
    assert run(spark, str(conf), str(root), str(out)) == 1
    assert run(spark, str(tmp_path / "empty"), str(root), str(out)) == 2
    with pytest.raises(ValueError, match="unknown postprocess"):
        postprocess(spark.createDataFrame([("a", "b")], "uuid string, text string"), [{"kind": "nope"}])


def test_stream_takes_new_files_once(spark, tmp_path):
    from gristmill.streaming.normalise import normalise_stream

    src, out, ck = (tmp_path / n for n in ("src", "out", "ck"))
    src.mkdir()
    listed = spark.createDataFrame([("b",)], "id string")
    for n, ids in enumerate((("a", "b"), ("c",))):
        (src / f"{n}.jsonl").write_text("".join(json.dumps({"id": i, "text": f"t {i}"}) + "\n" for i in ids) + "bad\n")
        normalise_stream(spark, str(src), str(out), str(ck), "nemotron-pretraining-sft-v1", "ds", listed).awaitTermination()
    assert sorted(g["uuid"] for g in lines_below(out)) == ["a", "c"]


# --- the contract ------------------------------------------------------------------------------------------------------


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["uuid", "text"]


def test_queries_equal_their_oracles(spark):
    import duckdb

    from gristmill import queries

    con = duckdb.connect()
    for t in ("nation", "customer", "part", "orders", "events", "documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    plain = lambda rows, names: sorted(str([round(x, 9) if isinstance(x, float) else x for _, x in sorted(zip(names, r, strict=True))]) for r in rows)
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        want = con.execute(sql)
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(got.columns), name
        assert plain(map(tuple, got.collect()), got.columns) == plain(want.fetchall(), names), name
