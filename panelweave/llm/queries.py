"""The registered queries of the operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import contamination, hostrules, licenses, lm, packing, periodic, secrets, simhash, tokencounts, toxicity, vectorcodes, warc, weaklabel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS low FROM p),
b AS (SELECT *, list_transform([1, 6, 11, 16, 21, 26, 31, 36], lambda i: CAST('0x' || substr(hex, i, 5) AS BIGINT)) AS v FROM d)
SELECT page_id, payload_bytes, array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0],
  lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> s) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = low THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> low THEN low END AS refers_to
FROM b
"""


@query(OP1_SQL)
def op1_warc(spark, sf_dir):
    """Every page through an archive and back; a record that breaks the format fails the query."""
    found = warc.archive_pages(spark, table(spark, sf_dir, "pages"))
    kind = F.when(F.col("error").isNull(), F.col("record_type")).otherwise(F.raise_error(F.col("error")).cast("string"))
    return found.select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"), "refers_to")


ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {ITEM_WORDS} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {ITEM_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, list_slice(w, k, k + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
places AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT len(win) AS n FROM wins) WHERE len(w) >= n),
hits AS (SELECT DISTINCT r, k, n, item FROM places JOIN wins ON list_slice(w, k, k + n - 1) = win),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

OP4_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
d AS (SELECT r, doc_id, source, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
places AS (SELECT r, w, unnest(range(1, len(w) - 3)) AS k FROM d WHERE len(w) >= 5),
twice AS (SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, list_slice(w, k, k + 4)) AS c FROM places) WHERE c > 1),
repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + 5)) AS p FROM twice) GROUP BY r),
f AS (SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines, coalesce(repeats.n, 0) AS n_repeat_words FROM d LEFT JOIN repeats USING (r)),
g AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words AS failed FROM f),
h AS (SELECT source, count(*) AS n, sum(CAST(failed AS INTEGER)) AS failed FROM g GROUP BY source),
m AS (SELECT (sum(failed) + 0.5) / (sum(n) + 1) AS mean, sum(failed) / sum(n) AS p, count(*) AS k, sum(n) AS n, sum(n * (failed / n) * (failed / n)) AS square FROM h),
v AS (SELECT mean, square / n - p * p - mean * (1 - mean) * k / n AS spread FROM m),
s AS (SELECT mean, CASE WHEN spread > 0 THEN least(greatest(mean * (1 - mean) / spread - 1, 2.0), 1e6) ELSE 1e6 END AS strength FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (h.failed + mean * strength) / (h.n + strength) <= 0.5 AS kept,
  CAST(round((h.failed + mean * strength) / (h.n + strength) * 1e6) AS BIGINT) AS host_rate_ppm
FROM g JOIN h ON g.source IS NOT DISTINCT FROM h.source, s
"""


@query(OP2_SQL)
def op2_decontamination(spark, sf_dir):
    """Every document against every benchmark item, in windows of ten words."""
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query()
def op3_simhash(spark, sf_dir):
    """Every document's fingerprint and component of near-duplicates."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(OP4_SQL)
def op4_host_rules(spark, sf_dir):
    """Every document's counts and verdict, with sources as hosts."""
    found = hostrules.host_quality(table(spark, sf_dir, "documents"), host_col="source")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round(F.col("host_rate") * 1e6).cast("long").alias("host_rate_ppm"))


@query()
def op5_quality_classifier(spark, sf_dir):
    """Every document's weak label, score and verdict; no given label is read."""
    return weaklabel.quality_scores(table(spark, sf_dir, "documents")).drop("text_hash")


@query()
def op6_toxicity(spark, sf_dir):
    """Every document's toxicity, learned from the labels outside the held-out third."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=3, held_out=1, threshold=0.7)


def _matches_sql(kind: str, rank: int) -> str:
    """One kind's matches: all of them, their second groups, and what stands between them."""
    pattern = "'" + (secrets.STRONG | secrets.WEAK)[kind].replace("'", "''") + "'"
    value = f"regexp_extract_all(text, {pattern}, 2)" if kind in ("assign", "short") else "m"
    valid = {
        "assign": "length(v[k]) >= 12",
        "short": "length(v[k]) BETWEEN 6 AND 11",
        "blob": "regexp_matches(m[k], '[A-Z]') AND regexp_matches(m[k], '[a-z]') AND regexp_matches(m[k], '[0-9]')",
    }.get(kind, "TRUE")
    return f"""SELECT r, '{kind}' AS kind, {rank} AS rank, '{secrets.PART[kind]}' AS part, e - length(m[k]) AS s, e FROM (
      SELECT *, list_sum(list_transform(g[1:k], lambda x: length(x))) + list_sum(list_transform(m[1:k], lambda x: length(x))) AS e FROM (
      SELECT *, unnest(range(1, len(m) + 1)) AS k FROM (
      SELECT r, regexp_extract_all(text, {pattern}) AS m, {value if value != "m" else f"regexp_extract_all(text, {pattern})"} AS v, regexp_split_to_array(text, {pattern}) AS g
      FROM t WHERE regexp_matches(text, {pattern})))) WHERE {valid}"""


OP7_SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(_matches_sql(kind, rank) for rank, kind in enumerate(secrets.KINDS))}),
n AS (SELECT *, {", ".join(
    f"coalesce(s - max(CASE WHEN part = '{p}' THEN e END) OVER b <= 240, FALSE) OR coalesce(min(CASE WHEN part = '{p}' THEN s END) OVER a - e <= 240, FALSE) AS has_{p}"
    for p in ("id", "secret")
)} FROM f WINDOW b AS (PARTITION BY r ORDER BY s, e, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  a AS (PARTITION BY r ORDER BY s, e, rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
x AS (SELECT r, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS span, kind, s, rank, e FROM n WHERE rank < {len(secrets.STRONG)}
  OR CASE part WHEN 'id' THEN has_secret WHEN 'secret' THEN has_id ELSE has_id AND has_secret END),
g AS (SELECT r, string_agg(span, ',' ORDER BY s, rank, e) AS spans, string_agg(span, ',' ORDER BY s, rank, e) FILTER (rank < {len(secrets.STRONG)}) AS base,
  {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.STRONG)} FROM x GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.STRONG)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (r)
"""


@query(OP7_SQL)
def op7_secrets(spark, sf_dir):
    """Every document's secret spans."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"), reach=240)
    strong = F.filter("spans", lambda x: x["rank"] < len(secrets.STRONG))

    def count(rank: int):
        return F.size(F.filter("spans", lambda x: x["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{name}") for rank, name in enumerate(secrets.STRONG)]
    return found.select("doc_id", *counts, F.sha2(secrets.joined_spans(strong), 256).alias("base_sha256"), secrets.joined_spans(F.col("spans")).alias("spans"))


@query()
def op8_lm_scores(spark, sf_dir):
    """Every document's log-probability, learned from four fifths of the documents."""
    return lm.lm_scores(table(spark, sf_dir, "documents"), folds=5, held_out=1)


@query()
def op9_licenses(spark, sf_dir):
    """Every document's license phrases and detections."""
    found = licenses.license_scan(table(spark, sf_dir, "documents"))
    labels = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *labels, "score", F.array_join("spans", ",").alias("spans"))


@query()
def op10_packing(spark, sf_dir):
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 2048)


_SQUARE = " + ".join(f"(p.q[{i}] - c.q[{i}]) * (p.q[{i}] - c.q[{i}])" for i in range(1, 5))
_MEAN = ", ".join(f"CAST(floor(sum(p.q[{i}]) / count(*)) AS BIGINT)" for i in range(1, 5))


def _nearest_sql(n: int) -> str:
    """Each part's nearest entry in the codebooks of round n; ties to the lower index, as 64 entries share a distance."""
    return f"""a{n} AS (SELECT r, part, key % 64 AS e, key // 64 AS d FROM (
      SELECT r, p.part, min(({_SQUARE}) * 64 + e) AS key FROM p JOIN c{n} c ON p.part = c.part GROUP BY ALL))"""


def _next_sql(n: int) -> str:
    return f"""c{n + 1} AS (SELECT c.part, c.e, coalesce(m.q, c.q) AS q FROM c{n} c LEFT JOIN (
      SELECT part, e, [{_MEAN}] AS q FROM a{n} JOIN p USING (r, part) GROUP BY part, e) m ON c.part = m.part AND c.e = m.e)"""


OP11_SQL = f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT r, vec_id, part, list_slice(v, 4 * part + 1, 4 * part + 4) AS q FROM k, (SELECT unnest(range(16)) AS part)),
c0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, q FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)),
{_nearest_sql(0)}, {_next_sql(0)}, {_nearest_sql(1)}, {_next_sql(1)}, {_nearest_sql(2)},
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN codes USING (r), h
"""


@query(OP11_SQL)
def op11_vector_codes(spark, sf_dir):
    """Every usable vector as a code of 16 parts, by codebooks of 64 entries fitted in two rounds."""
    return vectorcodes.vector_codes(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


@query()
def op12_periodic_runs(spark, sf_dir):
    """Every document's periodic runs of words, one document in ten made periodic first."""
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), shortest=24, times=3, rewrite=True)


@query()
def op13_token_counts(spark, sf_dir):
    """Every document's tokens, and how far it may be read within 1024 of them, from its table of prefix counts."""
    return tokencounts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), limit=1024)
