"""The registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import alignment, decontaminate, divergence, hosts, lines, mixing, packing, quality, scoring, sharding, simhash, suffixes, tokenbin
from logweave.session import new_dir

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHARDS = 40


@query()
def op1_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return sharded.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def quality_sql() -> str:
    """The counts by unnested windows, then the iterations of the estimate written one by one."""
    rules = quality.RULES
    k = len(rules)
    vote = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v{j}" for j, (_, bad, good, *_) in enumerate(rules))
    v = ", ".join(f"v{j}" for j in range(k))

    def posterior(a: str) -> str:
        g = " * ".join(f"CASE v{j} WHEN 1 THEN {a}.a{j} WHEN -1 THEN 1 - {a}.a{j} ELSE 1.0::DOUBLE END" for j in range(k))
        b = " * ".join(f"CASE v{j} WHEN 1 THEN 1 - {a}.a{j} WHEN -1 THEN {a}.a{j} ELSE 1.0::DOUBLE END" for j in range(k))
        return f"({quality.PRIOR}::DOUBLE * {g}) / ({quality.PRIOR}::DOUBLE * {g} + (1 - {quality.PRIOR})::DOUBLE * {b})"

    def rate(j: int) -> str:
        right = f"SUM(CASE v{j} WHEN 1 THEN n * q WHEN -1 THEN n * (1 - q) ELSE 0 END)"
        cast = f"SUM(CASE WHEN v{j} <> 0 THEN n ELSE 0 END)"
        value = f"CASE WHEN {cast} > 0 THEN {right} / {cast} ELSE {quality.ACCURACY} END"
        return f"LEAST(GREATEST({value}, {rules[j][3]}::DOUBLE), {rules[j][4]}::DOUBLE) AS a{j}"

    steps = ["e0 AS MATERIALIZED (SELECT " + ", ".join(f"{quality.ACCURACY}::DOUBLE AS a{j}" for j in range(k)) + ")"]
    for i in range(quality.ITERATIONS):
        steps.append(f"e{i + 1} AS MATERIALIZED (SELECT {', '.join(map(rate, range(k)))} FROM (SELECT p.*, {posterior(f'e{i}')} AS q FROM p, e{i}))")
    return rf"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, COALESCE(text, '') AS t,
  regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(COALESCE(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT r, i, w[i:i+{quality.WINDOW - 1}] AS win FROM d, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS u(i)),
h AS (SELECT r, i FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1),
m AS (SELECT r, COUNT(DISTINCT i + o) AS n FROM h, unnest(range({quality.WINDOW})) AS u(o) GROUP BY r),
f AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
  len(l) - len(list_distinct(l)) AS n_dup_lines, COALESCE(m.n, 0) AS n_repeat_words,
  length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
  length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_marks,
  len(regexp_extract_all(t, '[.,;:][ \t-\r]')) AS n_ends FROM d LEFT JOIN m USING (r)),
c AS (SELECT *, {vote} FROM f),
p AS MATERIALIZED (SELECT {v}, COUNT(*)::DOUBLE AS n FROM c GROUP BY {v}),
{", ".join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND {posterior(f"e{quality.ITERATIONS}")} >= {quality.THRESHOLD} AS kept
FROM c, e{quality.ITERATIONS}"""


@query(quality_sql())
def op2_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_report(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


WEIGHTS = [5, 2, 1]
MAX_EPOCHS = 3

MIX_SQL = rf"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  md5('0:' || COALESCE(doc_id::VARCHAR, '-')) AS place FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
o AS (SELECT *, {MAX_EPOCHS} * source_size AS cap, SUM(source_size) OVER () AS total, SUM(weight) OVER () AS weights,
  COALESCE(SUM({MAX_EPOCHS} * source_size) OVER w, 0) AS caps, COALESCE(SUM(weight) OVER w, 0) AS used
  FROM s WINDOW w AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
q AS (SELECT *, weight * (total - caps)::BIGINT / (weights - used) > cap AS full_up FROM o),
r AS (SELECT SUM(source_size) - COALESCE(SUM(cap) FILTER (full_up), 0) AS remaining, SUM(weight) FILTER (NOT full_up) AS w FROM q),
t AS (SELECT source, source_size, CASE WHEN full_up THEN cap::DOUBLE ELSE weight * remaining::BIGINT / w::BIGINT END AS target FROM q, r),
n AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS reps FROM t),
a AS (SELECT d.doc_id, d.size, n.*, COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
  (size * CASE WHEN source_size > 0 THEN LEAST({MAX_EPOCHS}, reps + CASE WHEN 2 * ahead + size <= 2 * (target - reps * source_size) THEN 1 ELSE 0 END) ELSE 0 END)::BIGINT AS taken
FROM a"""


@query(MIX_SQL)
def op5_capped_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_report(table(spark, sf_dir, "documents"), WEIGHTS, MAX_EPOCHS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op8_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER_SQL = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CONTAMINATION_SQL = rf"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER_SQL}, '{WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER_SQL}, '{WORD}') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, w[s:s + LEAST(len(w), 13) - 1] AS win FROM b, unnest(range(1, GREATEST(len(w) - 12, 1) + 1)) AS u(s) WHERE len(w) > 0),
n AS (SELECT DISTINCT len(win) AS n FROM v),
c AS (SELECT r, s, n, w[s:s + n - 1] AS win FROM d, n, unnest(range(1, len(w) - n + 2)) AS u(s) WHERE len(w) >= n),
m AS (SELECT r, s, n, item_id FROM c JOIN v USING (win)),
h AS (SELECT r, COUNT(DISTINCT s + o) AS n_hit FROM (SELECT DISTINCT r, s, n FROM m), unnest(range(n)) AS u(o) GROUP BY r),
i AS (SELECT r, COUNT(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, len(w) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)"""


@query(CONTAMINATION_SQL)
def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The end of a document in the token files.
END_ID = 2


@query()
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_dir(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    manifest = tokenbin.write(table(spark, sf_dir, "documents"), path, vocabulary, END_ID, by_word=True)
    return tokenbin.read(spark, path, manifest)


LINES_SQL = r"""WITH d AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, i, l[i] AS line, translate(regexp_replace(regexp_replace(l[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM d, unnest(range(1, len(l) + 1)) AS u(i)),
s AS (SELECT k, MIN(doc_id) AS first FROM x WHERE length(k) >= 10 GROUP BY k HAVING COUNT(DISTINCT doc_id) > 1),
y AS (SELECT x.*, s.first IS NOT NULL AND s.first <> doc_id AS gone FROM x LEFT JOIN s USING (k))
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM y GROUP BY doc_id"""


@query(LINES_SQL)
def op7_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


#: 0.85 to this power is below 1e-10.
SQL_TURNS = 150


def hosts_sql() -> str:
    """The rules row by row, the turns of the propagation one by one, as many as doubles can tell apart."""
    rules = ", ".join(f"('{r}', '{r.split('/', 1)[0]}', '{r[len(r.split('/', 1)[0]):]}', '{v}')" for v, r in RULES)
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = hosts.LINK.replace("'", "''")
    d = hosts.DAMPING
    return rf"""WITH RECURSIVE r(rule, rh, rp, verdict) AS (VALUES {rules}),
p AS (SELECT page_id, {lower("regexp_extract(COALESCE(url, ''), '://([^/?#]*)', 1)")} AS host,
  regexp_extract(COALESCE(url, ''), '://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
w AS (SELECT page_id, host, path, html, (SELECT max_by({{'rule': r.rule, 'verdict': r.verdict}}, length(r.rule)) FROM r
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS best FROM p),
n AS (SELECT host, COUNT(*) AS pages, COUNT(*) FILTER (best.verdict = 'allow')::DOUBLE AS allowed,
  COUNT(*) FILTER (best.verdict = 'block')::DOUBLE AS blocked FROM w GROUP BY host),
a AS (SELECT host AS src, unnest(regexp_extract_all(COALESCE(html, ''), '{link}', 1)) AS href FROM w),
e AS (SELECT src, dst, COUNT(*) AS links FROM (SELECT src, {lower("regexp_extract(href, '//([^/?#]*)', 1)")} AS dst FROM a
  WHERE regexp_matches(href, '^([A-Za-z][A-Za-z0-9+.-]*:)?//')) WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2),
f AS (SELECT src, dst, links / SUM(links) OVER (PARTITION BY src) AS ahead, links / SUM(links) OVER (PARTITION BY dst) AS behind FROM e),
s AS (SELECT host, (1 - {d}) * allowed AS trust, (1 - {d}) * blocked AS distrust FROM n WHERE host <> '' AND (allowed > 0 OR blocked > 0)),
m AS (SELECT 0 AS turn, host, trust, distrust FROM s
  UNION ALL (SELECT turn + 1, host, SUM(trust), SUM(distrust) FROM (
    SELECT turn, dst AS host, {d} * trust * ahead AS trust, 0::DOUBLE AS distrust FROM m JOIN f ON m.host = src
    UNION ALL SELECT turn, src, 0::DOUBLE, {d} * distrust * behind FROM m JOIN f ON m.host = dst)
  WHERE turn < {SQL_TURNS} GROUP BY turn, host HAVING SUM(trust) > 0 OR SUM(distrust) > 0)),
k AS (SELECT host, SUM(trust) AS trust, SUM(distrust) AS distrust FROM m GROUP BY host),
v AS (SELECT n.host, CASE WHEN COALESCE(distrust, 0) > COALESCE(trust, 0) AND COALESCE(distrust, 0) / (1 - {d}) >= {hosts.THRESHOLD} * pages
  THEN 'block' ELSE 'allow' END AS by_host FROM n LEFT JOIN k ON k.host = n.host)
SELECT page_id, w.host, path, best.rule AS rule, COALESCE(best.verdict, by_host) AS verdict FROM w JOIN v ON w.host = v.host"""


@query(hosts_sql())
def op4_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hosts.judge(table(spark, sf_dir, "pages"), hosts.rules_frame(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return scoring.score_documents(table(spark, sf_dir, "documents"), vocabulary, 49_407)


TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SHARE_SQL = "1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * kept)"
DIVERGENCE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  regexp_extract_all({LOWER_SQL}, '{TERM}') AS w FROM documents),
o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING COUNT(DISTINCT r) >= {divergence.LEAST_DOCS}),
v AS (SELECT lang, COUNT(*) AS kept FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, COUNT(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
z AS (SELECT lang, source, term, COALESCE(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
t AS (SELECT lang, source, SUM(n)::HUGEINT AS total FROM z GROUP BY lang, source),
p AS MATERIALIZED (SELECT lang, source, term, n, {SHARE_SQL.format(n="n", total="total")} AS p FROM z JOIN t USING (lang, source) JOIN v USING (lang)),
a AS (SELECT lang, term, SUM(n)::HUGEINT AS n FROM c GROUP BY lang, term),
q AS (SELECT lang, term, {SHARE_SQL.format(n="n", total="total")} AS q FROM a JOIN (SELECT lang, SUM(n) AS total FROM a GROUP BY lang) USING (lang) JOIN v USING (lang)),
x AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, COALESCE(SUM((p - q) * (p - q) // (p + q)), 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN p ON p.lang = x.lang AND p.source = x.source
  LEFT JOIN (SELECT lang, source, term, p AS q FROM p) s ON s.lang = y.lang AND s.source = y.source AND s.term = p.term GROUP BY ALL
UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM x)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}"""


@query(DIVERGENCE_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


#: The end of a document in the packed sequences, and their length.
PACK_END, PACK_LIMIT = 0, 2048


@query()
def op12_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack(table(spark, sf_dir, "documents"), vocabulary, PACK_END, PACK_LIMIT, by_word=True)
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.alignment_report(table(spark, sf_dir, "documents"), *paths)
