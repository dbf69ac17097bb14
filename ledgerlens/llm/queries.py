"""The registered queries of this package and their DuckDB SQL.

Every query reads whole tables, applies one operator with its production
parameters, and returns its full result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import table, workers_find_package

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def deco(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            workers_find_package(spark)
            return fn(spark, sf_dir)

        REGISTRY[fn.__name__] = run
        if oracle:
            ORACLES[fn.__name__] = oracle
        return run
    return deco


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ledgerlens.llm.token_counts import counted

    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counted(docs, path).withColumn("over_limit", F.col("n_tokens") > 4096)


@query(r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, k, array_to_string(ws[k:k + 12], ' ') AS win
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS k FROM w WHERE len(ws) >= 13)),
f AS (SELECT g.doc_id, g.k FROM g JOIN (SELECT win, min(doc_id) AS least FROM g GROUP BY win) m USING (win) WHERE g.doc_id > m.least),
c AS (SELECT DISTINCT doc_id, k + o AS p FROM f, (SELECT unnest(range(0, 13)) AS o)),
e AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
k AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.p) AS kept, count(*) AS n
      FROM e ANTI JOIN c ON e.doc_id = c.doc_id AND e.p = c.p GROUP BY e.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.substring_dedup import remove_repeated_windows

    out = remove_repeated_windows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@query()
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.simhash import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Byte limit of a shard in the query and the pipeline.
SHARD_BYTES = 1 << 20


@query(rf"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS doc_bytes,
                  lpad(bin(('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT), 60, '0') AS h
           FROM documents),
n AS (SELECT substr(h, 1, b) AS prefix, b, sum(doc_bytes) AS bytes, count(*) AS docs
      FROM d, (SELECT unnest(range(0, 61)) AS b) GROUP BY 1, 2),
f AS (SELECT * FROM n WHERE bytes <= {SHARD_BYTES} OR docs = 1),
r AS (SELECT doc_id, doc_bytes, h, min(f.b) AS b FROM d JOIN f ON f.prefix = substr(d.h, 1, f.b) GROUP BY ALL)
SELECT r.doc_id, r.doc_bytes, CASE WHEN r.b = 0 THEN 'root' ELSE substr(r.h, 1, r.b) END AS shard, f.bytes::BIGINT AS shard_bytes
FROM r JOIN f ON f.prefix = substr(r.h, 1, r.b) AND f.b = r.b""")
def op3_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES).select("doc_id", "doc_bytes", "shard", "shard_bytes")


@query(r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5('6|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || CASE WHEN k > 0 THEN '|' || k ELSE '' END), 1, 13))::BIGINT
             / 4503599627370496.0::DOUBLE AS u
           FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, coalesce(text, '') ORDER BY lang NULLS FIRST, source NULLS FIRST, n_chars NULLS FIRST) - 1 AS k FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM d GROUP BY source),
t AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
             coalesce(sum(3 * source_size) OVER o, 0) AS taken, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS share, row_number() OVER (ORDER BY 3 * source_size / w, source NULLS LAST) AS pos
      FROM s WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min((total - taken)::BIGINT / share, pos) AS level FROM t WHERE cap > w * ((total - taken)::BIGINT / share)),
g AS (SELECT source, source_size, least(cap::DOUBLE, w * coalesce(level, 0)) AS target FROM t, l),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, d.u, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (u < rate - floor(rate))::INT))::BIGINT AS taken FROM r""")
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.mixing import mixed

    out = mixed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "mix.size", "mix.source_size", "mix.target",
                      (F.col("mix.size") * F.col("mix.copies")).cast("long").alias("taken"))


@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM b WHERE len(w) > 0)),
q AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY 1),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN q USING (item_id) WHERE n_shared >= ceil(n_item * 0.8 - 1e-9)""")
def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


#: The conversation that the contract of the chat query adds.
EXTRA_CONVERSATION = (-7, r"\### Assistant: </turn> ok")


@query(r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
e AS (SELECT *, replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\' || chr(10)) AS r,
             replace(replace(text, '\', '\\'), '<|', '<\|') AS t FROM c),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
             coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(length('<|turn|>') + length(r) + 1 + length(t) + length('<|end|>'))::BIGINT AS formatted_chars
      FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""")
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.chat_format import digests

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv, said = EXTRA_CONVERSATION
    extra = spark.range(2).select(F.lit(conv).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digests(rows.union(extra))


#: A line on more than this share of a host's pages, and on two pages at least, is boilerplate.
BOILERPLATE_RATIO = 0.2


@query(rf"""
WITH p AS (SELECT page_id, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '')) AS host,
                  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
                    '(?is)<script\b.*?</script\s*>', '', 'g'), '(?is)<style\b.*?</style\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'),
                    '(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>', chr(10), 'g'),
                    '<[^>]*>', '', 'g') AS txt FROM pages),
l AS (SELECT page_id, host, list_filter(list_transform(regexp_split_to_array(txt, '[\n\r]'), lambda x: trim(x)), lambda x: x != '') AS lines FROM p),
h AS (SELECT host, count(*) AS host_pages FROM l WHERE host != '' GROUP BY 1),
c AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM l) GROUP BY ALL),
b AS (SELECT host, list(line) AS bad FROM c JOIN h USING (host) WHERE n > 1 AND n > host_pages * {BOILERPLATE_RATIO} GROUP BY 1),
k AS (SELECT page_id, host, host_pages, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
      FROM l LEFT JOIN h USING (host) LEFT JOIN b USING (host))
SELECT page_id, host, coalesce(host_pages, 0)::BIGINT AS host_pages, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
       array_to_string(kept, chr(10)) AS kept_text FROM k""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.line_dedup import drop_boilerplate

    return drop_boilerplate(table(spark, sf_dir, "pages"), BOILERPLATE_RATIO)


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.quality import scored

    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""")
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


#: False rejections allowed per stratum, the error probability of that promise, and
#: the good documents one wrongly kept bad one is worth.
RISK, DELTA, GOOD_COST = 0.05, 0.05, 10


@query(rf"""
WITH d AS (SELECT doc_id, lang AS stratum, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, k, array_to_string(w[k:k + 4], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5)),
t AS (SELECT doc_id, k FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
r AS (SELECT doc_id, count(DISTINCT k + o) AS n FROM t, (SELECT unnest(range(0, 5)) AS o) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
c AS (SELECT doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper, len(regexp_extract_all(text, '[0-9]'))::BIGINT AS n_digits,
             len(regexp_extract_all(text, '[!?"''()\[\]{{}}=+_/\\^~`@;:-]'))::BIGINT AS n_marks
      FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, greatest(word_chars, 1) AS wc,
             ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 3 AS part FROM c),
s AS (SELECT doc_id, stratum, part, base_failed, unnest(range(0, 8)) AS rule, unnest([1000 * n_symbols // wc, 1000 * n_dup_lines // greatest(n_lines, 1),
             1000 * n_repeat_words // greatest(n_words, 1), 1000 * n_upper // wc, 1000 * n_digits // wc, 1000 * n_marks // wc,
             1000 - 1000 * n_words // wc, 1000 * n_words // wc]) AS share FROM v),
y AS (SELECT s.*, labels.quality AS y FROM s JOIN labels USING (doc_id) WHERE NOT base_failed AND labels.quality IN (0, 1)),
h AS (SELECT stratum, rule, share, sum(1 - y) AS bad, sum(y) AS good FROM y WHERE part = 0 GROUP BY ALL),
q AS (SELECT stratum, rule, share, lead(share) OVER o AS below, sum(bad) OVER o - {GOOD_COST} * sum(good) OVER o AS gain FROM h WINDOW o AS (PARTITION BY stratum, rule ORDER BY share DESC)),
b AS (SELECT * FROM q WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, share DESC) = 1),
p AS (SELECT stratum, rule, (coalesce(below, share) + share + 1) // 2 AS cutoff, row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, rule) AS step FROM b),
f AS (SELECT y.doc_id, y.stratum, min(p.step) FILTER (y.share >= p.cutoff) AS hit
      FROM y JOIN p ON y.stratum IS NOT DISTINCT FROM p.stratum AND y.rule = p.rule WHERE y.part <> 0 AND y.y = 1 GROUP BY ALL),
k AS (SELECT p.stratum, p.step, count(*) AS n, count(*) FILTER (f.hit <= p.step) AS x FROM p JOIN f ON f.stratum IS NOT DISTINCT FROM p.stratum GROUP BY ALL),
z AS (SELECT stratum, step, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK}))) AS tail
      FROM (SELECT *, unnest(range(0, x + 1)) AS i FROM k WHERE x < n * {RISK}) GROUP BY ALL),
a AS (SELECT stratum, max(step) AS steps FROM z WHERE tail <= {DELTA} / (SELECT count(*) FROM p) GROUP BY 1),
u AS (SELECT p.* FROM p JOIN a ON a.stratum IS NOT DISTINCT FROM p.stratum WHERE p.step <= a.steps),
x AS (SELECT DISTINCT s.doc_id FROM s JOIN u ON s.stratum IS NOT DISTINCT FROM u.stratum AND s.rule = u.rule WHERE s.share >= u.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND x.doc_id IS NULL AS kept
FROM v LEFT JOIN x USING (doc_id)""")
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.quality_rules import judged

    out = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), RISK, DELTA, GOOD_COST)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Centroids, rounds, components, scale and seed of the clustering query.
CENTROIDS, ROUNDS, DIMS, SCALE, CLUSTER_SEED = 40, 5, 64, 256, 2


def _clusters_sql() -> str:
    """All rounds, unrolled; m0 are the first centroids."""
    steps = [rf"""
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIMS}),
m0 AS MATERIALIZED (SELECT (row_number() OVER o - 1)::INTEGER AS c, v AS m FROM v WINDOW o AS (ORDER BY sha256('{CLUSTER_SEED}:' || vec_id), v)
      QUALIFY row_number() OVER o <= {CENTROIDS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS (SELECT vec_id, v, c, list_sum(list_transform(range(1, {DIMS} + 1), lambda j: (v[j] - m[j]) * (v[j] - m[j])))::BIGINT AS distance FROM v, m{i}),
a{i} AS MATERIALIZED (SELECT vec_id, v, c, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY vec_id, v ORDER BY distance, c) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} AS (SELECT c, list(z ORDER BY j) AS m FROM (SELECT c, j, floor(sum(x)::DOUBLE / count(*))::BIGINT AS z FROM (SELECT c, unnest(v) AS x, unnest(range({DIMS})) AS j FROM a{i}) GROUP BY ALL) GROUP BY c),
m{i + 1} AS MATERIALIZED (SELECT m{i}.c, coalesce(s{i}.m, m{i}.m) AS m FROM m{i} LEFT JOIN s{i} USING (c))""")
    return ",".join(steps) + f"""
SELECT vec_id, c AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{ROUNDS} JOIN m{ROUNDS} USING (c)"""


@query(_clusters_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.centroids import clustered

    return clustered(table(spark, sf_dir, "embeddings"), CENTROIDS, ROUNDS, DIMS, SCALE, CLUSTER_SEED)


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))
