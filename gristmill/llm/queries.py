"""The registered queries of this package: thin digests of the operators' results."""

from __future__ import annotations

from . import bagminhash, lines, mixing, multiprobe, passages, quality, rules, sentencepiece_codec, toxicity, warc

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


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


BASE32 = " || ".join(
    f"lpad(to_base(('0x' || substr(sha1(coalesce(html, '')), {i}, 5))::BIGINT, 32), 4, '0')" for i in range(1, 41, 5)
)


@query(f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         translate(upper({BASE32}), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM pages)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
""")
def op3_warc_revisits(spark, sf_dir):
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


@query()
def op4_multiprobe_search(spark, sf_dir):
    return multiprobe.search(table(spark, sf_dir, "embeddings"))


@query()
def op5_repeated_passages(spark, sf_dir):
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@query()
def op6_sentencepiece(spark, sf_dir, model=None):
    import public_tokenizers

    model = sentencepiece_codec.load(model or public_tokenizers.path("piece_bpe_32k.model"))
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), model)


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""
WITH d AS (SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM d, unnest(range(1, len(w) - 6)) AS r(i) WHERE len(w) >= 8),
rep AS (SELECT doc_id, i FROM win WHERE true QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, unnest(range(0, 8)) AS r(k) GROUP BY doc_id),
ln AS (SELECT doc_id, source, text, pos, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
       FROM (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln WHERE n > 0 GROUP BY doc_id),
k AS (SELECT doc_id, source, n, translate(lower(trim(line, {SPACES})), '123456789', '000000000') AS key FROM ln WHERE n > 0),
over AS (SELECT source, key FROM k GROUP BY source, key HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) > {rules.MAX_DOCS}),
lost AS (SELECT k.doc_id, sum(k.n) AS n FROM k JOIN over o ON k.source IS NOT DISTINCT FROM o.source AND k.key = o.key GROUP BY k.doc_id),
b AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(dup.n, 0) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_lost
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT} * n_words AS base_failed,
       NOT (n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT} * n_words)
         AND n_words - n_lost >= {rules.MIN_WORDS} AND n_words - n_lost >= {rules.KEEP} * n_words AS kept
FROM b
""")
def op7_line_frequency(spark, sf_dir):
    return rules.judge(table(spark, sf_dir, "documents"))


@query(f"""
WITH ln AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM ln),
f AS (SELECT key, count(DISTINCT doc_id) AS n, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key),
m AS (SELECT k.*, coalesce(f.n >= 5 AND k.doc_id < f.keeper, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op8_line_dedup(spark, sf_dir):
    return lines.digests(table(spark, sf_dir, "documents"))


@query()
def op9_bagminhash(spark, sf_dir):
    return bagminhash.classes(table(spark, sf_dir, "documents"))


@query(f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
                  md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][nth % 3 + 1]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM s),
o AS (SELECT *, cap / w AS ratio FROM r),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT source, source_size, coalesce(least(cap, w * (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1)), cap) AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
x AS (SELECT d.*, g.source_size, g.target, g.whole, floor(g.target)::BIGINT - g.whole * g.source_size AS remains,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, whole * size + least(size, greatest(remains - before, 0)) AS taken FROM x
""")
def op10_mixing(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))
