"""Registered queries of the core engine, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import ensure_text, est_tokens, stable_u
from .functions.tools import call_args, call_names, call_payloads, cluster_label, parse_call, string_class, value_type
from .functions import tools
from .functions.variant import member
from .operators import adapters, filters, mcq, param_pool, pretty, sampling
from .plans import pipeline
from .session import tasks_of
from .sources import sinks
from .sources.sinks import scratch
from .sources.readers import read, read_json_array, read_jsonl
from .sources.readers import parsed as parsed_lines

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its oracle."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_records(rows: DataFrame, file: str, pos: str, **fields) -> DataFrame:
    """Rows as what a reader gives: file, pos and an object of the fields."""
    return rows.select(F.lit(file).alias("file"), F.col(pos).alias("pos"), F.to_variant_object(F.struct(*[v.alias(k) for k, v in fields.items()])).alias("raw"))


def turns_of(spark: SparkSession, sf_dir: str, **fields) -> DataFrame:
    """conv_id and turns: an array of the fields of each turn, in order."""
    turn = F.struct("turn", *[v.alias(k) for k, v in fields.items()])
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return rows.select("conv_id", F.transform("t", lambda x: F.struct(*[x[k].alias(k) for k in fields])).alias("turns"))


# --- transcripts ---------------------------------------------------------------------------------------------------

TRANSCRIPT = """
t AS (SELECT conv_id, string_agg('<|' || role || '|>' || chr(10) || trim(text), chr(10) || chr(10) ORDER BY turn) AS text
      FROM conversations WHERE trim(text) <> '' GROUP BY conv_id)"""


@query(f"WITH {TRANSCRIPT} SELECT 'conversations/' || conv_id AS uuid, text FROM t")
def q01_transcript(spark, sf_dir):
    rows = as_records(turns_of(spark, sf_dir, role=F.col("role"), content=F.col("text")), "conversations", "conv_id", conversations=F.col("turns"))
    return adapters.prepare(adapters.adapt(rows, "agent-data-collection", "conversations"))


@query(f"""
WITH {TRANSCRIPT}, c AS (SELECT count(*) FILTER (contains(text, '<|user|>') AND contains(text, '<|assistant|>')) AS a, count(*) AS n FROM t)
SELECT 'cpt_sft' AS bucket, a AS n FROM c UNION ALL SELECT 'other', n - a FROM c""")
def q02_classify_counts(spark, sf_dir):
    return pretty.bucket_counts(pretty.classify(q01_transcript(spark, sf_dir)))


@query("""
SELECT CASE lower(role) WHEN 'user' THEN 'user' WHEN 'system' THEN 'system' WHEN 'tool' THEN 'tool' ELSE 'assistant' END AS mapped, count(*) AS n
FROM conversations GROUP BY 1""")
def q03_role_map(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy(adapters.map_role(F.col("role")).alias("mapped")).agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT conv_id, turn, role, trim(text) AS c, 'step ' || turn AS d FROM conversations),
p AS (SELECT conv_id, turn, CASE role
   WHEN 'user' THEN '<|assistant|>' || chr(10) || '<think>' || chr(10) || d || chr(10) || '</think>' || chr(10) || chr(10)
     || '<|assistant|>' || chr(10) || '<|tool_call|>' || chr(10) || c || chr(10) || '</|tool_call|>'
   WHEN 'assistant' THEN '<|assistant|>' || chr(10) || '<think>' || chr(10) || c || chr(10) || '</think>' || chr(10) || chr(10) || '<|assistant|>' || chr(10) || d
   ELSE '<|tool|>' || chr(10) || c || chr(10) || chr(10) || '<|assistant|>' || chr(10) || d END AS x FROM s WHERE c <> '')
SELECT 'steps/' || conv_id AS uuid, string_agg(x, chr(10) || chr(10) ORDER BY turn) AS text FROM p GROUP BY conv_id""")
def q04_step_wrap(spark, sf_dir):
    source = F.when(F.col("role") == "user", "code_action").when(F.col("role") == "assistant", "thought").otherwise("observation")
    rows = turns_of(spark, sf_dir, source=source, content=F.col("text"), description=F.concat(F.lit("step "), F.col("turn").cast("string")))
    return adapters.prepare(adapters.adapt(as_records(rows, "steps", "conv_id", content=F.col("turns")), "agent-data-collection", "steps"))


@query("""
WITH p AS (SELECT conv_id, turn, role || CASE role WHEN 'assistant' THEN chr(10) || 'because ' || turn ELSE '' END
           || CASE trim(text) WHEN '' THEN '' ELSE chr(10) || trim(text) END AS x FROM conversations)
SELECT 'math/' || conv_id AS uuid, string_agg(x, chr(10) ORDER BY turn) AS text FROM p GROUP BY conv_id""")
def q05_reasoning_lines(spark, sf_dir):
    rows = turns_of(spark, sf_dir, role=F.col("role"), content=F.col("text"), reasoning_content=F.concat(F.lit("because "), F.col("turn").cast("string")))
    return adapters.prepare(adapters.adapt(as_records(rows, "math", "conv_id", messages=F.col("turns")), "nemotron-math-v2", "math"))


@query("""
SELECT 'glaive/' || conv_id AS uuid, trim(coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'system'), '') || chr(10) || chr(10)
       || coalesce(string_agg(upper(role) || ': ' || text, chr(10) ORDER BY turn) FILTER (role <> 'system'), ''), ' ' || chr(10)) AS text
FROM conversations GROUP BY conv_id""")
def q06_system_prompt_concat(spark, sf_dir):
    rows = turns_of(spark, sf_dir, role=F.col("role"), content=F.col("text"))
    system = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == "system"), lambda t: t["content"]), " ")
    chat = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] != "system"), lambda t: F.concat(F.upper(t["role"]), F.lit(": "), t["content"])), "\n")
    return adapters.prepare(adapters.adapt(as_records(rows, "glaive", "conv_id", system=system, chat=chat), "glaive", "glaive"))


# --- texts, samples and budgets --------------------------------------------------------------------------------------


@query(r"""
SELECT doc_id, sha1(x) AS text_sha1, length(x) AS n FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS x FROM documents) WHERE x <> ''""")
def q07_ensure_text_filter(spark, sf_dir):
    docs = filters.non_empty(table(spark, sf_dir, "documents").select("doc_id", ensure_text(F.col("text")).alias("text")))
    return docs.select("doc_id", F.sha1(F.col("text").cast("binary")).alias("text_sha1"), F.length("text").cast("long").alias("n"))


TOKENS = "CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, length(text) // 4) END::BIGINT"


@query(f"SELECT lang, source, sum({TOKENS})::BIGINT AS tokens, count(*) AS docs FROM documents GROUP BY lang, source")
def q08_token_estimate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "source", est_tokens(F.col("text")).alias("tokens"))
    return docs.groupBy("lang", "source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))


U = "(('0x' || substr(sha1({}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE)"


@query(f"SELECT doc_id, u FROM (SELECT doc_id, {U.format('doc_id::VARCHAR')} AS u FROM documents) WHERE u < 0.3")
def q09_stable_sample(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    return sampling.hash_sample(table(spark, sf_dir, "documents"), 0.3, key).select("doc_id", stable_u(key).alias("u"))


@query(f"""
SELECT doc_id::VARCHAR AS id, sha1(CASE WHEN {U.format('doc_id::VARCHAR')} < 0.5
  THEN 'SYSTEM:' || chr(10) || 'Answer in ' || lang || '.' || chr(10) || chr(10) || trim(text, ' ' || chr(10)) ELSE trim(text, ' ' || chr(10)) END) AS text_sha1 FROM documents WHERE trim(text) <> ''""")
def q10_system_mixin(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = as_records(docs, "documents", "doc_id", id=F.col("doc_id").cast("string"), text=F.col("text"), system=F.concat(F.lit("Answer in "), "lang", F.lit(".")))
    out = adapters.adapt(rows, "nemotron-pretraining-sft-v1", "documents", system_ratio=0.5)
    return out.select("id", F.sha1(F.col("text").cast("binary")).alias("text_sha1"))


def _tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", est_tokens(F.col("text")).alias("tokens"))
    return docs.where("tokens > 0")


@query(f"""
WITH d AS (SELECT doc_id, {TOKENS} AS tokens FROM documents),
r AS (SELECT *, sum(tokens) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS run, row_number() OVER (ORDER BY doc_id) AS n FROM d WHERE tokens > 0)
SELECT doc_id, tokens FROM r WHERE run <= 100000 OR n = 1""")
def q11_budget_global(spark, sf_dir):
    return sampling.token_budget(_tokens(spark, sf_dir), 100_000, [F.col("doc_id")])


@query(f"""
WITH d AS (SELECT doc_id, {TOKENS} AS tokens FROM documents),
k AS (SELECT *, ((row_number() OVER (ORDER BY doc_id) - 1) % 4)::INT AS rank FROM d WHERE tokens > 0),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY rank ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS run, row_number() OVER (PARTITION BY rank ORDER BY doc_id) AS n FROM k)
SELECT doc_id, tokens, rank FROM r WHERE run <= 25001 OR n = 1""")
def q12_budget_by_rank(spark, sf_dir):
    return sampling.token_budget(_tokens(spark, sf_dir), 100_001, [F.col("doc_id")], "rank", 4)


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 7)::INT AS rank FROM documents")
def q13_round_robin(spark, sf_dir):
    return sampling.round_robin(table(spark, sf_dir, "documents").select("doc_id"), 7, [F.col("doc_id")])


# --- exclusion and unions ------------------------------------------------------------------------------------------


def _documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("id"), "text", F.struct(F.lit("documents").alias("dataset")).alias("metadata"))


@query("SELECT doc_id::VARCHAR AS id, length(text) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def q14_exclude_ids(spark, sf_dir):
    listed = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    return filters.exclude_ids(_documents(spark, sf_dir), listed).select("id", F.length("text").cast("long").alias("n"))


@query("""
SELECT 'documents::' || doc_id AS uuid, length(text) AS n FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""")
def q15_exclude_ids_mixed(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    plain = labels.where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))
    prefixed = labels.where("quality = 0").select(F.concat(F.lit("documents::"), "doc_id").alias("id"))
    kept = filters.exclude_ids(_documents(spark, sf_dir), plain.union(prefixed), mixed=True)
    return adapters.prepare(kept, mixed=True).select("uuid", F.length("text").cast("long").alias("n"))


@query("""
SELECT DISTINCT id FROM (SELECT doc_id::VARCHAR AS id FROM labels UNION ALL SELECT 'item-' || item_id FROM benchmark UNION ALL SELECT 'u"' || user_id FROM events)""")
def q16_blacklist_union(spark, sf_dir):
    lines = [
        table(spark, sf_dir, "labels").select(F.concat(F.lit('{"doc_id": '), "doc_id", F.lit("}")).alias("line")),
        table(spark, sf_dir, "benchmark").select(F.concat(F.lit("  item-"), "item_id", F.lit(" ")).alias("line")),
        table(spark, sf_dir, "events").select(F.concat(F.lit('{"text": "x", "uuid": "", "id": "u\\"'), "user_id", F.lit('"}')).alias("line")),
    ]
    ids = [x.select(filters.line_id(F.col("line")).alias("id")) for x in lines]
    return ids[0].union(ids[1]).union(ids[2]).distinct()


@query("""
SELECT 'documents::' || doc_id AS uuid, length(text) AS n FROM documents
UNION ALL SELECT 'benchmark::' || item_id, length(text) FROM benchmark UNION ALL SELECT 'pages::' || page_id, length(html) FROM pages""")
def q17_mixed_union(spark, sf_dir):
    parts = [("documents", "doc_id", "text"), ("benchmark", "item_id", "text"), ("pages", "page_id", "html")]
    rows = [table(spark, sf_dir, t).select(F.col(k).cast("string").alias("id"), F.col(c).alias("text"), F.struct(F.lit(t).alias("dataset")).alias("metadata")) for t, k, c in parts]
    mixed = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return adapters.prepare(mixed, mixed=True).select("uuid", F.length("text").cast("long").alias("n"))


@query("SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE (n - 1) % 5 = 0")
def q18_every_n(spark, sf_dir):
    from pyspark.sql.window import Window

    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    line = docs.withColumn("line", F.row_number().over(Window.partitionBy("source").orderBy("doc_id")))
    return filters.every_n(line, 5, F.col("line"), 1).drop("line")


# --- chat logs -----------------------------------------------------------------------------------------------------


@query(r"""
WITH log AS (SELECT conv_id, 'before' || chr(10) || string_agg(CASE role WHEN 'system' THEN text ELSE upper(role) || ' : ' || text END, chr(10) ORDER BY turn) AS log FROM conversations GROUP BY conv_id),
ln AS (SELECT conv_id, unnest(string_split(log, chr(10))) AS line, generate_subscripts(string_split(log, chr(10)), 1) AS i FROM log),
m AS (SELECT *, regexp_matches(trim(line), '^(?i:user|assistant)\s*:') AS opens FROM ln),
g AS (SELECT *, sum(opens::INT) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM m),
b AS (SELECT conv_id, g, lower(regexp_extract(trim(first(line ORDER BY i)), '^(?i:(user|assistant))', 1)) AS role,
             regexp_replace(string_agg(CASE WHEN opens THEN regexp_replace(trim(line), '^(?i:user|assistant)\s*:\s*', '') ELSE line END, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g') AS c FROM g WHERE g > 0 GROUP BY conv_id, g),
t AS (SELECT conv_id, string_agg('<|' || role || '|>' || CASE c WHEN '' THEN '' ELSE chr(10) || c END, chr(10) || chr(10) ORDER BY g) AS text FROM b GROUP BY conv_id)
SELECT 'logs/' || log.conv_id AS uuid, coalesce(t.text, log) AS text FROM log LEFT JOIN t USING (conv_id)""")
def q19_chatlog_parse(spark, sf_dir):
    rows = turns_of(spark, sf_dir, role=F.col("role"), content=F.col("text"))
    said = F.transform("turns", lambda t: F.when(t["role"] == "system", t["content"]).otherwise(F.concat(F.upper(t["role"]), F.lit(" : "), t["content"])))
    rows = as_records(rows, "logs", "conv_id", text=F.concat(F.lit("before\n"), F.array_join(said, "\n")))
    return adapters.prepare(adapters.adapt(rows, "hephaestus", "logs"))


@query("""
SELECT doc_id::VARCHAR AS uuid, '<|user|>' || chr(10) || 'Task: ' || lang || '-' || source || chr(10) || chr(10) || '<|assistant|>' || chr(10) || 'Action:' || chr(10)
       || 'look' || chr(10) || 'Action: Agent.' || n_chars AS text FROM documents""")
def q20_task_action_split(spark, sf_dir):
    text = F.concat(F.lit(" Task: "), "lang", F.lit("-"), "source", F.lit(" \nAction: look\nAction: Agent."), "n_chars", F.lit("\n"))
    rows = as_records(table(spark, sf_dir, "documents"), "documents", "doc_id", id=F.col("doc_id").cast("string"), text=text)
    return adapters.prepare(adapters.adapt(rows, "hephaestus", "documents"))


# --- tool calls ----------------------------------------------------------------------------------------------------


def call_texts(spark, sf_dir) -> DataFrame:
    """uuid and text: the events of each user as tool calls, in order."""
    call = F.concat(F.lit('<|tool_call|>\n{"name": "'), "event_type", F.lit('", "arguments": '), "props", F.lit("}\n</|tool_call|>"))
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "props").repartition(tasks_of(spark), "user_id")
    rows = events.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", call.alias("c")))).alias("calls"))
    return rows.select(F.col("user_id").cast("string").alias("uuid"), F.array_join(F.transform("calls", lambda x: x["c"]), "\n\n").alias("text"))


@query("""
WITH f AS (SELECT user_id, event_type, min(event_id) AS e FROM events GROUP BY user_id, event_type),
n AS (SELECT user_id, string_agg(event_type, ',' ORDER BY e) AS names FROM f GROUP BY user_id)
SELECT user_id::VARCHAR AS uuid, names, count(*)::INT AS calls, sum((props->>'$.k')::BIGINT)::BIGINT AS sum_k FROM events JOIN n USING (user_id) GROUP BY user_id, names""")
def q21_tool_call_extract(spark, sf_dir):
    texts = call_texts(spark, sf_dir)
    k = F.transform(call_payloads(F.col("text")), lambda p: F.try_variant_get(call_args(parse_call(p)), "$.k", "long"))
    return texts.select("uuid", F.array_join(call_names(F.col("text")), ",").alias("names"), F.size(call_payloads(F.col("text"))).alias("calls"), F.aggregate(k, F.lit(0).cast("long"), lambda s, x: s + x).alias("sum_k"))


@query("""
WITH g AS (SELECT user_id || '-' || event_id // 200 AS id, event_type, (props->>'$.k')::BIGINT % 5 AS k FROM events)
SELECT id, count(*) > count(DISTINCT event_type || '/' || k) AS skipped FROM g GROUP BY id""")
def q22_duplicate_call_filter(spark, sf_dir):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "long") % 5
    message = F.struct(F.lit("assistant").alias("role"), F.lit("calls").alias("content"), F.struct(F.col("event_type").alias("name"), k.alias("k")).alias("function_call"))
    rows = table(spark, sf_dir, "events").withColumn("id", F.concat("user_id", F.lit("-"), F.floor(F.col("event_id") / 200)))
    rows = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("event_id", message.alias("m")))).alias("ms"))
    rows = as_records(rows.withColumn("zero", F.lit(0)), "events", "zero", uuid=F.col("id"), messages=F.transform("ms", lambda x: x["m"]))
    out = adapters.adapt(rows, "toucan", "events", keep_skipped=True)
    return out.select("id", F.col("metadata.skip_reason").isNotNull().alias("skipped"))


def _values(spark, sf_dir) -> DataFrame:
    """src and v: values of several kinds."""
    one = lambda t, c, name: table(spark, sf_dir, t).select(F.lit(name).alias("src"), F.to_variant_object(F.struct(c.alias("v"))).alias("o")).select("src", member(F.col("o"), "v").alias("v"))
    events = table(spark, sf_dir, "events").select(F.lit("k").alias("src"), member(F.try_parse_json("props"), "k").alias("v"))
    objects = table(spark, sf_dir, "events").select(F.lit("props").alias("src"), F.try_parse_json("props").alias("v"))
    parts = [one("customer", F.col("c_acctbal"), "acctbal"), one("part", F.col("p_name"), "name"), one("part", F.col("p_size") > 10, "large"), one("part", F.array("p_brand"), "brands"), one("nation", F.lit(None).cast("string"), "none")]
    out = events.union(objects)
    for p in parts:
        out = out.union(p)
    return out


@query("""
SELECT 'k' AS src, 'integer' AS p_type, count(*) AS n FROM events UNION ALL SELECT 'props', 'object', count(*) FROM events
UNION ALL SELECT 'acctbal', 'number', count(*) FROM customer UNION ALL SELECT 'name', 'string', count(*) FROM part
UNION ALL SELECT 'large', 'boolean', count(*) FROM part UNION ALL SELECT 'brands', 'array', count(*) FROM part UNION ALL SELECT 'none', 'unknown', count(*) FROM nation""")
def q23_param_types(spark, sf_dir):
    return _values(spark, sf_dir).groupBy("src", value_type(F.col("v")).alias("p_type")).agg(F.count("*").alias("n"))


STRINGS = "SELECT url AS s FROM pages UNION ALL SELECT p_name FROM part UNION ALL SELECT p_brand FROM part UNION ALL SELECT text FROM benchmark UNION ALL SELECT doc_id::VARCHAR FROM documents UNION ALL SELECT 'a/b' || o_orderpriority FROM orders UNION ALL SELECT o_orderpriority FROM orders"


@query(rf"""
SELECT CASE WHEN regexp_matches(lower(s), '^https?://') THEN 'string:url'
  WHEN regexp_matches(lower(s), '^(file|s3)://') OR contains(s, '/') OR contains(s, '\') THEN 'string:path_or_uri'
  WHEN len(regexp_extract_all(s, '\S+')) >= 6 THEN 'string:long_text' WHEN regexp_full_match(s, '\p{{Nd}}+') THEN 'string:numeric'
  WHEN regexp_matches(s, '\p{{Nd}}') AND regexp_matches(s, '\p{{L}}') THEN 'string:alnum' ELSE 'string:general' END AS class, count(*) AS n
FROM ({STRINGS}) GROUP BY 1""")
def q24_string_class(spark, sf_dir):
    t = lambda name, c: table(spark, sf_dir, name).select(c.alias("s"))
    parts = [t("pages", F.col("url")), t("part", F.col("p_name")), t("part", F.col("p_brand")), t("benchmark", F.col("text")), t("documents", F.col("doc_id").cast("string")), t("orders", F.concat(F.lit("a/b"), "o_orderpriority")), t("orders", F.col("o_orderpriority"))]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    return rows.groupBy(string_class(F.col("s")).alias("class")).agg(F.count("*").alias("n"))


INT_CLUSTER = """CASE WHEN v < 0 THEN 'number:negative' WHEN v = 0 THEN 'number:zero' ELSE 'number:positive' END || ':' || CASE WHEN abs(v) < 10 THEN 'single_digit'
 WHEN abs(v) < 100 THEN 'two_digits' WHEN abs(v) < 10000 THEN 'four_digits' WHEN abs(v) < 100000000 THEN 'eight_digits' ELSE 'huge' END"""


@query(f"""
SELECT src, cluster, count(*) AS n FROM (
  SELECT 'k' AS src, {INT_CLUSTER} AS cluster FROM (SELECT (props->>'$.k')::BIGINT AS v FROM events)
  UNION ALL SELECT 'acctbal', CASE WHEN abs(v) = 0 THEN 'number:zero' WHEN abs(v) < 1 THEN 'number:fraction' WHEN abs(v) < 10 THEN 'number:small' WHEN abs(v) < 100 THEN 'number:medium'
    WHEN abs(v) < 1000 THEN 'number:large' ELSE 'number:huge' END FROM (SELECT c_acctbal AS v FROM customer)
  UNION ALL SELECT 'large', 'boolean' FROM part UNION ALL SELECT 'brands', 'array' FROM part UNION ALL SELECT 'props', 'object' FROM events
  UNION ALL SELECT 'none', 'unknown' FROM nation) GROUP BY src, cluster""")
def q25_cluster_label(spark, sf_dir):
    rows = _values(spark, sf_dir).where("src <> 'name'")
    return rows.groupBy("src", cluster_label(value_type(F.col("v")), F.col("v")).alias("cluster")).agg(F.count("*").alias("n"))


@query("""
SELECT CASE grouping(event_type) + 2 * grouping(param) WHEN 0 THEN 'function' WHEN 1 THEN 'param' ELSE 'type' END AS level,
       coalesce(event_type, '') AS func, coalesce(param, '') AS param, 'integer' AS p_type, count(*) AS observed
FROM (SELECT event_type, 'k' AS param, 'integer' AS t FROM events) GROUP BY GROUPING SETS ((event_type, param), (param), (t))""")
def q26_param_pool_levels(spark, sf_dir):
    pool = param_pool.pool_from_texts(call_texts(spark, sf_dir))
    return pool.select("level", F.coalesce("func", F.lit("")).alias("func"), F.coalesce("param", F.lit("")).alias("param"), "p_type", "observed").distinct()


@query(f"""
WITH v AS (SELECT event_type AS func, (props->>'$.k')::BIGINT AS v, user_id::VARCHAR AS uuid, event_id FROM events),
c AS (SELECT *, {INT_CLUSTER} AS cluster FROM v),
f AS (SELECT func, cluster, v, count(*) AS n, min(struct_pack(uuid := uuid, e := event_id)) AS first FROM c GROUP BY func, cluster, v),
r AS (SELECT *, row_number() OVER (PARTITION BY func, cluster ORDER BY first) AS nth FROM f)
SELECT func, cluster, sum(n)::BIGINT AS "count", string_agg(v::VARCHAR, ',' ORDER BY nth) FILTER (nth <= 10) AS "values" FROM r GROUP BY func, cluster""")
def q27_capped_values(spark, sf_dir):
    pool = param_pool.pool_from_texts(call_texts(spark, sf_dir), max_values=10).where("level = 'function'")
    return pool.select("func", "cluster", "count", F.array_join("values", ",").alias("values"))


def _shuffled(items: str, seed: str) -> str:
    """SQL for by_hash()."""
    return f"list_transform(list_sort(list_transform({items}, lambda x: struct_pack(h := sha1({seed} || '|' || x), x := x))), lambda e: e.x)"


@query(f"""
WITH r AS (SELECT DISTINCT event_type AS name, ['k', event_type] AS req FROM events),
o AS (SELECT name, [array_to_string(req, ', '), req[1], array_to_string(req, ', ') || ', extra', '(none)'] AS o FROM r),
k AS (SELECT name, list_transform(generate_series(1, 4), lambda i: (i - 1)::VARCHAR || ':' || o[i]) AS o FROM o)
SELECT name, array_to_string(list_transform({_shuffled('o', "name || '|p'")}, lambda s: s[3:]), '|') AS options FROM k""")
def q28_required_param_options(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("name")).distinct()
    return rows.select("name", F.array_join(mcq.params_options(F.array(F.lit("k"), F.col("name")), F.col("name")), "|").alias("options"))


@query(f"""
WITH f AS (SELECT user_id, event_type, min(event_id) AS e FROM events GROUP BY user_id, event_type),
n AS (SELECT user_id, list(event_type ORDER BY e) AS names FROM f GROUP BY user_id),
c AS (SELECT user_id, event_id, event_type AS name, names, user_id || '|' || (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) AS seed,
             '<|tool_call|>' || chr(10) || '{{"name": "' || event_type || '", "arguments": ' || props || '}}' || chr(10) || '</|tool_call|>' AS call FROM events JOIN n USING (user_id)),
d AS (SELECT *, {_shuffled("list_filter(names, lambda n: n <> name)", "seed || '|d'")} AS others FROM c),
o AS (SELECT *, {_shuffled("list_concat([name], others[1:3])", "seed || '|o'")} AS o FROM d),
q AS (SELECT *, CASE WHEN len(names) < 2 THEN '' ELSE '<|mcq_tool|>' || chr(10) || 'Instruction: Choose the next tool to call based on the dialogue context.' || chr(10) || 'Options:' || chr(10)
        || array_to_string(list_transform(generate_series(1, len(o)), lambda i: '  ' || ['A', 'B', 'C', 'D'][i] || ') ' || o[i]), chr(10)) || chr(10)
        || 'Answer: ' || ['A', 'B', 'C', 'D'][list_position(o, name)] || chr(10) || '</|mcq_tool|>' END AS q FROM o)
SELECT user_id::VARCHAR AS uuid, sha1(string_agg(q || call, chr(10) || chr(10) ORDER BY event_id)) AS text_sha1 FROM q GROUP BY user_id""")
def q29_mcq_tool(spark, sf_dir):
    out = mcq.augment(call_texts(spark, sf_dir))
    return out.select("uuid", F.sha1(F.col("text").cast("binary")).alias("text_sha1"))


def _asked(tag: str, instruction: str, options: str, answer: str) -> str:
    """SQL for a question with lettered options."""
    return f"""'<|{tag}|>' || chr(10) || 'Instruction: ' || {instruction} || chr(10) || 'Options:' || chr(10)
        || array_to_string(list_transform(generate_series(1, len({options})), lambda i: '  ' || ['A', 'B', 'C', 'D'][i] || ') ' || {options}[i]), chr(10)) || chr(10)
        || 'Answer: ' || ['A', 'B', 'C', 'D'][list_position({options}, {answer})] || chr(10) || '</|{tag}|>'"""


CALLS = f"""
f AS (SELECT user_id, event_type, min(event_id) AS e FROM events GROUP BY user_id, event_type),
n AS (SELECT user_id, list(event_type ORDER BY e) AS names FROM f GROUP BY user_id),
c AS (SELECT user_id, event_id, event_type AS name, names, props->>'$.k' AS k, user_id || '|' || (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) AS seed,
             '<|tool_call|>' || chr(10) || '{{"name": "' || event_type || '", "arguments": ' || props || '}}' || chr(10) || '</|tool_call|>' AS call FROM events JOIN n USING (user_id)),
d AS (SELECT *, {_shuffled("list_filter(names, lambda n: n <> name)", "seed || '|d'")} AS others FROM c),
o AS (SELECT *, {_shuffled("list_concat([name], others[1:3])", "seed || '|o'")} AS o FROM d),
q AS (SELECT *, CASE WHEN len(names) < 2 THEN '' ELSE {_asked('mcq_tool', "'Choose the next tool to call based on the dialogue context.'", 'o', 'name')} END AS q FROM o)"""


@query(f"""
WITH {CALLS},
pv AS (SELECT event_type AS func, (props->>'$.k')::BIGINT AS v, user_id::VARCHAR AS uuid, event_id FROM events),
pf AS (SELECT func, {INT_CLUSTER} AS cluster, v, min(struct_pack(uuid := uuid, e := event_id)) AS first FROM pv GROUP BY func, cluster, v),
pr AS (SELECT *, row_number() OVER (PARTITION BY func, cluster ORDER BY first) AS nth FROM pf),
p AS (SELECT func, list(v::VARCHAR ORDER BY sha1(v::VARCHAR)) AS choices FROM pr WHERE nth <= 120 GROUP BY func),
s AS (SELECT q.*, choices, ('0x' || substr(sha1(seed || '|k'), 1, 8))::BIGINT % len(choices) AS start FROM q JOIN p ON func = name),
w AS (SELECT *, '{{"k": ' || k || '}}' AS answer, list_transform(list_filter(list_concat(choices, choices)[start + 1:start + 4], lambda x: x <> k)[1:3], lambda v: '{{"k": ' || v || '}}') AS few FROM s),
x AS (SELECT *, ({_shuffled('few', "seed || '|n'")})[1:3] AS wrong FROM w),
y AS (SELECT *, {_shuffled('list_concat(wrong, [answer])', "seed || '|v'")} AS v FROM x),
z AS (SELECT *, q || CASE WHEN len(wrong) = 0 THEN '' ELSE {_asked('mcq_param_values', "'Choose the correct argument object for the tool call.'", 'v', 'answer')} END AS qs FROM y)
SELECT user_id::VARCHAR AS uuid, sha1(string_agg(qs || call, chr(10) || chr(10) ORDER BY event_id)) AS text_sha1,
       sha1(string_agg(call, chr(10) || chr(10) ORDER BY event_id)) AS before_sha1 FROM z GROUP BY user_id""")
def q30_mcq_values(spark, sf_dir):
    texts = call_texts(spark, sf_dir)
    out = mcq.augment(texts, pool=param_pool.pool_from_texts(texts), prefer_values=True)
    return out.select("uuid", F.sha1(F.col("text").cast("binary")).alias("text_sha1"), F.sha1(mcq.without_questions(F.col("text")).cast("binary")).alias("before_sha1"))


# --- rendering -----------------------------------------------------------------------------------------------------


@query("""
SELECT 'conversations/' || conv_id AS uuid, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS n, role, sha1(trim(text)) AS content_sha1
FROM conversations WHERE trim(text) <> ''""")
def q31_split_tagged(spark, sf_dir):
    blocks = q01_transcript(spark, sf_dir).select("uuid", F.posexplode(pretty.split_tagged(F.col("text"))).alias("n", "b"))
    return blocks.select("uuid", "n", "b.role", F.sha1(F.trim(F.regexp_replace("b.content", r"^\n|\n+\z", "")).cast("binary")).alias("content_sha1"))


@query("""
SELECT 'conversations/' || conv_id AS uuid, string_agg('[' || role || ']' || chr(10)
  || array_to_string(list_transform(string_split(trim(text), chr(10)), lambda l: CASE WHEN trim(l) = '' THEN l ELSE '  ' || l END), chr(10)), chr(10) ORDER BY turn) AS pretty
FROM conversations WHERE trim(text) <> '' GROUP BY conv_id""")
def q32_pretty(spark, sf_dir):
    return pretty.pretty_blocks(q01_transcript(spark, sf_dir), "uuid")


# --- files ---------------------------------------------------------------------------------------------------------


@query("""SELECT 3::BIGINT AS files, sum(strlen('{"doc_id":' || doc_id || ',"source":"' || source || '"}') + 1)::BIGINT AS bytes FROM documents""")
def q33_file_stats(spark, sf_dir):
    path = scratch(spark)
    sinks.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "source"), path, 3)
    return sinks.file_sizes(spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("""
WITH RECURSIVE s AS (SELECT source, sum(strlen(doc_id::VARCHAR) + 1)::BIGINT AS n, row_number() OVER (ORDER BY sum(strlen(doc_id::VARCHAR) + 1) DESC, source) AS i FROM documents GROUP BY source),
r AS (SELECT 0::BIGINT AS i, [0, 0, 0, 0]::BIGINT[] AS held, ''::VARCHAR AS source, 0::BIGINT AS n, 0::INT AS bin
      UNION ALL SELECT s.i, list_transform(held, lambda x, k: x + CASE WHEN k = list_position(held, list_min(held)) THEN s.n ELSE 0 END), s.source, s.n, (list_position(held, list_min(held)) - 1)::INT
      FROM r JOIN s ON s.i = r.i + 1)
SELECT source, n, bin FROM r WHERE i > 0""")
def q34_lpt_merge(spark, sf_dir):
    """One file for each source, merged into four by size; the bins are read back from where the lines went."""
    docs, path = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("value")), scratch(spark)
    docs.repartition("source").write.partitionBy("source").text(f"{path}/in")
    sinks.merge_files(spark, f"{path}/in", f"{path}/out", 4)
    lines = spark.read.text(f"{path}/out").select("value", F.col("merged").alias("bin"))
    return lines.join(docs, "value").groupBy("source", "bin").agg(F.sum(F.length("value") + 1).alias("n"))


@query("SELECT doc_id, lang, source, n_chars, sha1(text) AS text_sha1 FROM documents")
def q35_jsonl_roundtrip(spark, sf_dir):
    path = scratch(spark)
    sinks.write_jsonl(table(spark, sf_dir, "documents"), path)
    raw = read_jsonl(spark, [path])
    get = lambda k, t: F.try_variant_get("raw", f"$.{k}", t)
    return raw.select(get("doc_id", "long").alias("doc_id"), get("lang", "string").alias("lang"), get("source", "string").alias("source"), get("n_chars", "long").alias("n_chars"), F.sha1(get("text", "string").cast("binary")).alias("text_sha1"))


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '<|user|>' || chr(10) || props WHEN 2 THEN '<|assistant|>' || chr(10) || 'said' ELSE 'bare' END AS text FROM events""")
def q36_key_presence_fallback(spark, sf_dir):
    turn = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"role": "user", "content": null, "value": "hidden by content"}')))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('{"role": "", "from": "human", "value": '), "props", F.lit("}")))
        .when(F.col("event_id") % 4 == 2, F.lit('{"role": null, "speaker": "AI", "text": " said "}'))
        .otherwise(F.lit('{"content": "bare"}'))
    )
    return table(spark, sf_dir, "events").select("event_id", adapters.joined(F.array(adapters.turn_parts(F.try_parse_json(turn)))).alias("text"))


@query("""
SELECT CASE WHEN event_id % 4 = 0 THEN 'blank' WHEN event_id % 4 = 1 THEN 'null' WHEN event_id % 4 = 2 THEN 'bad' ELSE 'ok' END AS status, count(*) AS n FROM events GROUP BY 1""")
def q37_line_status(spark, sf_dir):
    line = F.when(F.col("event_id") % 4 == 0, " \t").when(F.col("event_id") % 4 == 1, "null").when(F.col("event_id") % 4 == 2, F.concat("props", F.lit("}"))).otherwise(F.col("props"))
    lines = table(spark, sf_dir, "events").select(line.alias("value"))
    return parsed_lines(lines).groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT doc_id, ((run - size) // 100000)::BIGINT AS shard FROM (SELECT doc_id, strlen(text) + 1 AS size, sum(strlen(text) + 1) OVER (ORDER BY doc_id) AS run FROM documents)")
def q38_rolled_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length("text") + 1).alias("size"))
    return sinks.with_shard(docs, F.col("size"), 100_000, [F.col("doc_id")]).select("doc_id", "shard")


# --- readers and lists of ids, through files -------------------------------------------------------------------------


@query("""
SELECT doc_id // 100 AS file, (row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) - 1) AS pos, CASE WHEN doc_id % 7 = 3 THEN NULL ELSE doc_id END AS doc_id,
       CASE WHEN doc_id % 7 = 3 THEN source || doc_id END AS value FROM documents WHERE doc_id % 100 < 90 OR doc_id // 100 <> 2""")
def q39_json_array(spark, sf_dir):
    """Top-level arrays with odd spacing, one a file; what isn't an object is wrapped, a truncated file keeps its whole items."""
    docs, path = table(spark, sf_dir, "documents"), scratch(spark)
    item = F.when(F.col("doc_id") % 7 == 3, F.to_json(F.array(F.concat("source", "doc_id")))).otherwise(F.concat(F.lit("["), F.to_json(F.struct("doc_id")), F.lit("]")))
    listed = docs.groupBy(F.floor(F.col("doc_id") / 100).alias("file")).agg(F.array_sort(F.collect_list(F.struct("doc_id", F.regexp_replace(item, r"^\[|\]$", "").alias("x")))).alias("xs"))
    # file 2 ends inside its item of doc_id 290
    items = F.transform("xs", lambda e: e["x"])
    whole = F.concat(F.lit(" [ "), F.array_join(items, " ,\r "), F.lit(" ] rest"))
    cut = F.concat(F.lit("["), F.array_join(F.transform(F.filter("xs", lambda e: e["doc_id"] % 100 < 90), lambda e: e["x"]), ","), F.lit(', {"doc_id": 2'))
    listed.select("file", F.when(F.col("file") == 2, cut).otherwise(whole).alias("value")).repartition("file").write.partitionBy("file").text(path)
    files = [r["path"] for r in sinks.file_sizes(spark, path).collect()]
    raw = read_json_array(spark, files)
    get = lambda k, t: F.try_variant_get("raw", f"$.{k}", t).alias(k)
    return raw.select(F.regexp_extract("file", r"file=(\d+)", 1).cast("long").alias("file"), "pos", get("doc_id", "long"), get("value", "string"))


@query("SELECT doc_id::VARCHAR AS doc_id, lang, source, n_chars::VARCHAR AS n_chars FROM documents")
def q40_csv(spark, sf_dir):
    """A header's names, values as strings."""
    path = scratch(spark)
    table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars").write.option("header", True).csv(path)
    raw = read(spark, "csv", [path])
    return raw.select(*[F.try_variant_get("raw", f"$.{k}", "string").alias(k) for k in ("doc_id", "lang", "source", "n_chars")])


@query("SELECT o_orderkey, o_totalprice, o_orderpriority, (row_number() OVER (ORDER BY o_orderkey) - 1) AS pos FROM orders WHERE o_orderkey <= 3000")
def q41_parquet(spark, sf_dir):
    """Rows as objects, positions in the file."""
    path = scratch(spark)
    rows = table(spark, sf_dir, "orders").where("o_orderkey <= 3000").select("o_orderkey", "o_totalprice", "o_orderpriority")
    rows.repartitionByRange(1, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    raw = read(spark, "parquet", [path])
    get = lambda k, t: F.try_variant_get("raw", f"$.{k}", t).alias(k)
    return raw.select(get("o_orderkey", "long"), get("o_totalprice", "double"), get("o_orderpriority", "string"), "pos")


@query("""
SELECT DISTINCT id FROM (SELECT 'u' || user_id AS id FROM events UNION ALL SELECT 'd"' || doc_id FROM labels UNION ALL SELECT '{' || item_id || '}' FROM benchmark UNION ALL SELECT 'n' || page_id FROM pages)""")
def q42_blacklist_files(spark, sf_dir):
    """JSON lines, gzipped ones, plain lists and bare lines, in folders of folders."""
    path = scratch(spark)
    put = lambda name, rows, **how: rows.write.options(**how).text(f"{path}/{name}")
    line = lambda t, c: table(spark, sf_dir, t).select(c.alias("value"))
    put("a/plain", line("benchmark", F.concat(F.lit(" {"), "item_id", F.lit("} "))))  # *.txt: whole lines, whatever they hold
    put("b/c/zipped", line("pages", F.concat(F.lit("n"), "page_id")), compression="gzip")
    named = line("events", F.concat(F.lit('{"text": "x", "uuid": "", "id": "u'), "user_id", F.lit('"}'))).union(line("labels", F.concat(F.lit('{"doc_id": "d\\"'), "doc_id", F.lit('"}'))))
    put("jsonl", named.coalesce(2))
    listed = filters.load_blacklist(spark, f"{path}/a").union(filters.load_blacklist(spark, f"{path}/b"))
    lines = spark.read.text(f"{path}/jsonl").select(filters.line_id(F.col("value"), compat=True).alias("id"))
    return listed.union(lines).where("id is not null").distinct()


# --- tool specifications ---------------------------------------------------------------------------------------------


def _tool_texts(spark, sf_dir):
    """p_partkey and text: a list of two tools for each part, one of them named at its top level, and a call of the first."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_type").repartition(tasks_of(spark), "p_partkey")
    size = F.col("p_size").cast("string")
    one = F.concat(F.lit('{"type": "function", "function": {"name": "make_'), size, F.lit('", "description": "  Make '), "p_brand", F.lit('. ", "parameters": {"type": "object", "required": ["brand", "size", '), size, F.lit(', null, true], "properties": {"brand": {"type": "string"}, "size": {"type": "integer"}}}}}'))
    two = F.concat(F.lit('{"name": "sell", "description": " '), "p_type", F.lit(' "}'))
    by_line = F.concat(one, F.lit("\n\nno json\n  "), two)
    listed = F.concat(F.lit("["), one, F.lit(", 7, "), two, F.lit("]"))
    tools = F.when(F.col("p_partkey") % 2 == 0, by_line).otherwise(listed)
    call = F.concat(F.lit("<|tool_call|>{'name': 'make_"), size, F.lit("', 'arguments': {'brand': 'x', 'size': 3}}</|tool_call|>"))
    return part.select(F.col("p_partkey").cast("string").alias("uuid"), F.concat(F.lit("<tools>\n"), tools, F.lit("\n</tools>\nsay "), call, F.lit(" end <|tool_call|>{'name': open")).alias("text"))


@query("""
SELECT p_partkey::VARCHAR AS uuid, 'make_' || p_size || ',sell' AS names, 'brand|size|' || p_size || '|true' AS required, 'brand,size' AS props,
       'Make ' || p_brand || '.; ' || p_type || ' ' AS described FROM part""")
def q43_tool_specs(spark, sf_dir):
    """X1, X3 to X6."""
    specs = _tool_texts(spark, sf_dir).select("uuid", tools.tool_specs(F.col("text")).alias("t"))
    each = lambda f: F.transform("t", f)
    props = F.array_sort(F.map_keys(tools.param_schema(F.col("t")[0])))
    return specs.select("uuid", F.array_join(each(tools.tool_name), ",").alias("names"), F.array_join(tools.required_params(F.col("t")[0]), "|").alias("required"), F.array_join(props, ",").alias("props"), F.array_join(each(tools.tool_description), ";").alias("described"))


TOOL_QUESTIONS = f"""
p AS (SELECT p_partkey::VARCHAR AS uuid, p_partkey || '|0' AS seed, 'make_' || p_size AS name, ['brand', 'size', p_size::VARCHAR, 'true'] AS req FROM part),
o AS (SELECT *, {_shuffled("list_concat([name], ['sell'])", "seed || '|o'")} AS o, array_to_string(req, ', ') AS answer FROM p),
k AS (SELECT *, list_transform({_shuffled("['0:' || answer, '1:' || array_to_string(req[1:3], ', '), '2:' || answer || ', extra', '3:(none)']", "seed || '|p'")}, lambda s: s[3:]) AS r FROM o),
q AS (SELECT *, {_asked('mcq_tool', "'Choose the next tool to call based on the dialogue context.'", 'o', 'name')} AS q1,
             {_asked('mcq_params', "'Choose the required parameters for the tool call (Required: ' || answer || ').'", 'r', 'answer')} AS q2 FROM k)"""


@query(f"WITH {TOOL_QUESTIONS} SELECT uuid, sha1(q1 || q2) AS asked_sha1, true AS same FROM q")
def q44_record_questions(spark, sf_dir):
    """M1, X17, X18 in a record: both questions come before its call; an open call stays as it is."""
    texts = _tool_texts(spark, sf_dir)
    out = mcq.augment(texts).withColumnRenamed("text", "done").join(texts, "uuid")
    asked = F.regexp_extract("done", r"(?s)say (<\|mcq_tool.*</\|mcq_params\|>)<\|tool_call", 1)
    return out.select("uuid", F.sha1(asked.cast("binary")).alias("asked_sha1"), (mcq.without_questions(F.col("done")) == F.col("text")).alias("same"))


@query(f"""
WITH {CALLS}, t AS (SELECT user_id, row_number() OVER (ORDER BY user_id::VARCHAR) - 1 AS nth FROM n)
SELECT user_id::VARCHAR AS uuid, sha1(string_agg(CASE WHEN nth % 3 = 0 THEN q ELSE '' END || call, chr(10) || chr(10) ORDER BY event_id)) AS text_sha1 FROM q JOIN t USING (user_id) GROUP BY user_id""")
def q45_augment_every(spark, sf_dir):
    """M4, M7: a chain of one step that asks in every third record, in the order of ids."""
    done, _ = pipeline.postprocess(call_texts(spark, sf_dir), [{"kind": "tool_mcq", "mcq_every_n": 3}])
    return done.select("uuid", F.sha1(F.col("text").cast("binary")).alias("text_sha1"))


@query(f"""
WITH v AS (SELECT event_type AS func, (props->>'$.k')::BIGINT AS v FROM events), c AS (SELECT *, {INT_CLUSTER} AS cluster FROM v)
SELECT CASE grouping(func) + grouping(p) WHEN 0 THEN 'function' WHEN 1 THEN 'param' ELSE 'type' END AS level, func, p AS param, cluster, count(*) AS "count", least(120, count(DISTINCT v)) AS kept
FROM (SELECT *, 'k' AS p, 'integer' AS t FROM c) GROUP BY GROUPING SETS ((func, p, cluster), (p, cluster), (t, cluster))""")
def q46_pool_as_json(spark, sf_dir):
    """The pool as nested JSON, and read from it again."""
    pool = param_pool.from_json(spark, param_pool.to_json(param_pool.pool_from_texts(call_texts(spark, sf_dir))))
    return pool.select("level", "func", "param", "cluster", "count", F.size("values").cast("long").alias("kept"))


# --- toucan, and records for people ------------------------------------------------------------------------------------


@query("""
WITH m AS (SELECT conv_id, turn, CASE role
    WHEN 'user' THEN CASE trim(text) WHEN '' THEN '' ELSE '<|user|>' || chr(10) || trim(text) || chr(10) || chr(10) END || '<|tool_call|>' || chr(10) || '{"k": ' || turn || ', "name": "f"}' || chr(10) || '</|tool_call|>'
    WHEN 'assistant' THEN CASE trim(text) WHEN '' THEN NULL ELSE '<|tool_output|>' || chr(10) || trim(text) END
    ELSE CASE trim(text) WHEN '' THEN '<|tool_call|>' || chr(10) || 'call ' || turn || chr(10) || '</|tool_call|>'
         ELSE '<|function|>' || chr(10) || trim(text) || chr(10) || chr(10) || '<|tool_output|>' || chr(10) || trim(text) END END AS x FROM conversations)
SELECT 'toucan/' || conv_id AS uuid, sha1(trim(string_agg(x, chr(10) || chr(10) ORDER BY turn), chr(10))) AS text_sha1 FROM m WHERE x IS NOT NULL GROUP BY conv_id""")
def q47_toucan(spark, sf_dir):
    """A1, A3: calls after their text, a tool's output in place of its message's last block."""
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    role = F.when(user, "user").when(assistant, "tool").otherwise("function")
    call = F.when(user, F.concat(F.lit('{"name": "f", "k": '), "turn", F.lit("}"))).when(~assistant, F.concat(F.lit('"call '), "turn", F.lit('"'))).otherwise("null")
    message = F.concat(F.lit('{"role": '), F.to_json(F.array(role)), F.lit(', "content": '), F.to_json(F.array("text")), F.lit(', "function_call": '), call, F.lit("}"))
    plain = F.regexp_replace(F.regexp_replace(message, r'"role": \[("[a-z]*")\]', r'"role": $1'), r'"content": \[(.*)\], "function_call"', r'"content": $1, "function_call"')
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", plain.alias("m")))).alias("ms"))
    rows = as_records(rows, "toucan", "conv_id", messages=F.concat(F.lit("["), F.array_join(F.transform("ms", lambda x: x["m"]), ", "), F.lit("]")))
    out = adapters.prepare(adapters.adapt(rows, "toucan", "toucan"))
    return out.select("uuid", F.sha1(F.col("text").cast("binary")).alias("text_sha1"))


@query("""
SELECT user_id::VARCHAR AS uuid, sha1(string_agg('[tool_call]' || chr(10) || '  {' || chr(10) || '    "name": "' || event_type || '",' || chr(10) || '    "arguments": {' || chr(10)
  || '      "k": ' || (props->>'$.k') || chr(10) || '    }' || chr(10) || '  }', chr(10) ORDER BY event_id)) AS pretty_sha1 FROM events GROUP BY user_id""")
def q48_pretty_calls(spark, sf_dir):
    """The JSON of calls with an indent of two."""
    return pretty.pretty_blocks(call_texts(spark, sf_dir), "uuid").select("uuid", F.sha1(F.col("pretty").cast("binary")).alias("pretty_sha1"))


@query("""
SELECT p_partkey::VARCHAR AS uuid, '=== Record ' || p_size || ' | id=' || p_partkey || ' ===' || chr(10) || 'Available tools:' || chr(10)
  || '  - make_' || p_size || chr(10) || '    Make ' || p_brand || '.' || chr(10) || '    required: brand, size, ' || p_size || ', true' || chr(10)
  || '  - sell' || chr(10) || '     ' || p_type || ' ' || chr(10) || 'Messages:' AS head FROM part""")
def q49_pretty_records(spark, sf_dir):
    """A header, the tools that the text lists, its messages."""
    texts = _tool_texts(spark, sf_dir)
    size = F.regexp_extract("text", r"make_(\d+)", 1)
    return pretty.pretty_records(texts, number=size).select("uuid", F.regexp_extract("record", r"(?s)^(.*?\nMessages:)", 1).alias("head"))
