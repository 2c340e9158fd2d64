"""The pool of parameter values that tool calls were seen with.

The pool is a tidy table (level, func, param, p_type, cluster, observed, count,
values): level "function" holds each function's parameters, "param" parameters of
any function, "type" all values of a type. values are the first max_values
distinct ones of a cluster, as JSON, in the order of the calls; count and observed
count all of them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.text import let
from ..functions.tools import call_args, call_payloads, cluster_label, param_schema, parse_call, tool_name, tool_specs, value_type
from ..functions.variant import as_map, as_string, canonical, display, member

LEVELS = ("function", "param", "type")
SCHEMA = "level string, func string, param string, p_type string, observed long, cluster string, count long, values array<string>"


def calls(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """One row for each parsed call with a name: keys, call_no, name, args, schema (its properties)."""
    rows = docs.select(*keys, F.posexplode(parsed_calls(F.col(text))).alias("call_no", "call"))
    return rows.where("call.name <> ''").select(*keys, "call_no", "call.name", "call.args", "call.schema")


def parsed_calls(text: Column) -> Column:
    """An array of (name, args, schema), one for each call of the text; the name is empty if there is none or the call can't be parsed.

    The last specification of a name gives the schema. Each call is parsed here once,
    before rows are made of them: later conditions and columns look at the result.
    """
    specs = F.transform(tool_specs(text), lambda t: F.named_struct(F.lit("name"), tool_name(t), F.lit("schema"), param_schema(t)))

    def of_call(c: Column, known: Column) -> Column:
        of_name = lambda n: F.element_at(F.filter(known, lambda s: s["name"] == n), -1)["schema"]
        seen = lambda n: F.named_struct(F.lit("name"), n, F.lit("args"), call_args(c), F.lit("schema"), F.when(F.exists(known, lambda s: s["name"] == n), of_name(n)))
        return let(F.coalesce(as_string(member(c, "name")), F.lit("")), seen)

    return let(specs, lambda known: F.transform(call_payloads(text), lambda p: let(parse_call(p), lambda c: of_call(c, known))))


def observations(called: DataFrame, *keys: str) -> DataFrame:
    """One row for each argument of a call: keys, call_no, func, param, value, p_type, cluster."""
    rows = called.select(*keys, "call_no", F.col("name").alias("func"), "schema", F.explode(as_map(F.col("args"))).alias("param", "value"))
    declared = as_string(member(F.element_at("schema", F.col("param")), "type"))
    rows = rows.withColumn("p_type", F.coalesce(F.nullif(declared, F.lit("")), value_type(F.col("value"))))
    return rows.withColumn("cluster", cluster_label(F.col("p_type"), F.col("value"))).drop("schema")


def build_pool(seen: DataFrame, order: list[Column], max_values: int = 120) -> DataFrame:
    """observations to a pool. order is the order of the calls' records.

    Values are made distinct and counted before any list is collected, so a
    cluster's list never holds more than max_values of them. Lists and counts read
    one exchange of these values: conditions that always hold keep all of its columns
    in both, whatever a query selects, so that Spark shares it.
    """
    at = F.struct(*order, "call_no", "param")
    rows = seen.select("func", "param", "p_type", "cluster", canonical(F.col("value")).alias("key"), at.alias("at"))
    # each value once for every (func, param, p_type, cluster), so later steps see few rows
    rows = rows.groupBy("func", "param", "p_type", "cluster", "key").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    level = F.explode(F.array(*[F.lit(x) for x in LEVELS])).alias("level")
    rows = rows.select(level, "*").withColumn("func", F.when(F.col("level") == "function", F.col("func"))).withColumn("param", F.when(F.col("level") != "type", F.col("param")))
    rows = rows.withColumn("group_type", F.when(F.col("level") == "type", F.col("p_type")))
    entry, bucket = ["level", "func", "param", "group_type"], ["level", "func", "param", "group_type", "cluster"]
    rows = rows.groupBy(*bucket, "key").agg(F.sum("n").alias("n"), F.min(F.struct("at", "p_type")).alias("first"))
    nth = F.row_number().over(W.Window.partitionBy(*bucket).orderBy("first"))
    # counts need all values, lists only the first ones
    counts = rows.groupBy(*bucket).agg(F.sum("n").alias("count"), F.min("first").alias("first")).where("count > 0 and first is not null")
    heads = rows.withColumn("nth", nth).where((F.col("nth") <= max_values) & (F.col("n") > 0))
    lists = heads.groupBy(*bucket).agg(F.transform(F.sort_array(F.collect_list(F.struct("nth", "key"))), lambda e: e["key"]).alias("values"))
    entries = counts.groupBy(*entry).agg(F.sum("count").alias("observed"), F.min("first")["p_type"].alias("p_type"))
    same = lambda a, b, on: [a[c].eqNullSafe(b[c]) for c in on]
    both = counts.join(lists, same(counts, lists, bucket)).select(*[counts[c] for c in bucket], "count", "values")
    out = both.join(entries, same(both, entries, entry)).select(*[both[c] for c in bucket[:3]], "p_type", "observed", "cluster", "count", "values")
    return out


def pool_from_texts(docs: DataFrame, key: str = "uuid", max_values: int = 120) -> DataFrame:
    """The pool of all tool calls in docs, in the order of key."""
    return build_pool(observations(calls(docs, key), key), [F.col(key)], max_values)


def to_json(pool: DataFrame) -> str:
    """The pool as one nested JSON text, for tools that read that. It is collected: the pool must be small."""
    out: dict = {"functions": {}, "params": {}, "types": {}}
    for r in pool.orderBy("level", "func", "param", "p_type", "cluster").toLocalIterator():
        if r["level"] == "function":
            entry = out["functions"].setdefault(r["func"], {"params": {}})["params"].setdefault(r["param"], {"type": r["p_type"], "required": False})
        elif r["level"] == "param":
            entry = out["params"].setdefault(r["param"], {"type": r["p_type"]})
        else:
            entry = out["types"].setdefault(r["p_type"], {})
        entry["observed"] = r["observed"]
        entry.setdefault("clusters", {})[r["cluster"]] = {"count": r["count"], "values": [json.loads(v) for v in r["values"]]}
    return json.dumps(out, ensure_ascii=False, indent=2)


def from_json(spark: SparkSession, text: str | None) -> DataFrame:
    """M6: a pool from its nested JSON; nothing or nonsense gives an empty pool."""
    try:
        data = json.loads(text or "{}")
    except ValueError:
        data = {}
    rows = []

    def add(level, func, param, p_type, entry):
        for cluster, c in (entry.get("clusters") or {}).items():
            rows.append((level, func, param, p_type, entry.get("observed", 0), cluster, c.get("count", 0), [json.dumps(v, ensure_ascii=False) for v in c.get("values") or []]))

    if isinstance(data, dict):
        for func, f in (data.get("functions") or {}).items():
            for param, entry in (f.get("params") or {}).items():
                add("function", func, param, entry.get("type"), entry)
        for param, entry in (data.get("params") or {}).items():
            add("param", None, param, entry.get("type"), entry)
        for p_type, entry in (data.get("types") or {}).items():
            add("type", None, None, p_type, entry)
    return spark.createDataFrame(rows, SCHEMA)


def alternatives(pool: DataFrame) -> DataFrame:
    """The pool with one list of values, as display JSON, for each entry: what J3 looks up.

    Lists are in the order of the values' SHA-1, so that neighbours in them are unrelated.
    """
    entry = ["level", "func", "param", F.when(F.col("level") == "type", F.col("p_type")).alias("t")]
    values = pool.groupBy(*entry).agg(F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"))
    shown = F.filter(F.transform("values", lambda x: display(F.try_parse_json(x))), lambda x: x.isNotNull())
    keyed = F.sort_array(F.transform(F.array_distinct(shown), lambda x: F.struct(F.sha1(x.cast("binary")).alias("h"), x.alias("x"))))
    return values.select("level", "func", "param", "t", F.transform(keyed, lambda e: e["x"]).alias("choices"))
