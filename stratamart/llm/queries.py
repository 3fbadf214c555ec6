"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op9_packing")
def packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from stratamart.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op3_warc")
def warc(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.warc import archive_round_trip

    return archive_round_trip(table(spark, folder, "pages"))


# Five hexadecimal digits are four digits of base 32.
_BASE_32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(sha, {5 * k + 1}, 5) AS INTEGER) >> {shift}) % 32, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)
ORACLE_SQL["op3_warc"] = f"""
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha FROM pages),
    first AS (SELECT payload, min(page_id) AS response FROM payloads GROUP BY payload)
    SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, {_BASE_32} AS payload_digest,
           CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> response THEN response END AS refers_to
    FROM payloads JOIN first USING (payload)"""


@query("op2_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.quality_classifier import fit, score

    docs = table(spark, folder, "documents")
    return score(docs, fit(docs, table(spark, folder, "labels")))


@query("op10_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.decontamination import contaminated

    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.jaccard_join import similar_documents

    return similar_documents(table(spark, folder, "documents"))


@query("op7_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.suffix_dedup import without_repeats

    return without_repeats(table(spark, folder, "documents"))


@query("op1_lm_scoring")
def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.lm_scoring import backoff_scores

    scores = backoff_scores(table(spark, folder, "documents"))
    # Rounded, so that the order in which logarithms are added does not show.
    return scores.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


ORACLE_SQL["op1_lm_scoring"] = r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
        FROM documents),
    tokens AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM texts),
    grams AS (
        SELECT doc_id, w, lag(w) OVER d AS p, lag(w, 2) OVER d AS q FROM tokens WINDOW d AS (PARTITION BY doc_id ORDER BY k)),
    ones AS (SELECT w, count(*) AS c FROM tokens GROUP BY w),
    twos AS (SELECT p, w, count(*) AS c FROM grams WHERE p IS NOT NULL GROUP BY p, w),
    threes AS (SELECT q, p, w, count(*) AS c FROM grams WHERE q IS NOT NULL GROUP BY q, p, w),
    total AS (SELECT count(*) AS n FROM tokens),
    counted AS (
        SELECT doc_id, n, CAST(g.p IS NOT NULL AS INT) + CAST(g.q IS NOT NULL AS INT) AS before,
               threes.c AS c3, b.c AS below3, twos.c AS c2, a.c AS below2, ones.c AS c1
        FROM grams g CROSS JOIN total JOIN ones ON ones.w = g.w
        LEFT JOIN ones a ON a.w = g.p LEFT JOIN twos ON twos.p = g.p AND twos.w = g.w
        LEFT JOIN twos b ON b.p = g.q AND b.w = g.p LEFT JOIN threes ON threes.q = g.q AND threes.p = g.p AND threes.w = g.w),
    scored AS (
        SELECT doc_id, CASE WHEN c3 >= 2 THEN 0 WHEN c2 >= 2 THEN before - 1 ELSE before END AS steps,
               CASE WHEN c3 >= 2 THEN ln(c3) - ln(below3) WHEN c2 >= 2 THEN ln(c2) - ln(below2) ELSE ln(c1) - ln(n) END
                 + steps * ln(0.4) AS s
        FROM counted)
    SELECT doc_id, len(ws) AS n_tokens, CAST(coalesce(sum(steps), 0) AS BIGINT) AS n_backoffs,
           round(coalesce(sum(s), 0), 6) AS log_score,
           CASE WHEN len(ws) > 0 THEN round(sum(s) / len(ws), 6) END AS mean_log_score
    FROM texts LEFT JOIN scored USING (doc_id) GROUP BY doc_id, ws"""


@query("op4_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.quality_rules import judged

    return judged(table(spark, folder, "documents"))


@query("op5_secret_scan")
def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.secret_scan import secrets

    return secrets(table(spark, folder, "documents"))


@query("op8_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.license_scan import licenses

    return licenses(table(spark, folder, "documents"))


@query("op11_filter_audit")
def filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.filter_audit import audit

    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


ORACLE_SQL["op11_filter_audit"] = r"""
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
    words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM texts),
    first AS (SELECT text, min(doc_id) AS least FROM texts GROUP BY text),
    marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
    flags AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
               [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
                100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails
        FROM words JOIN first USING (text) LEFT JOIN marks USING (doc_id)),
    counts AS (
        SELECT part, fails, len(list_filter(fails, lambda f: f)) AS k, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
        FROM flags GROUP BY part, fails),
    letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f),
    orders AS (
        SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
    steps AS (SELECT o, f AS step, o[f] AS filter, o[:f - 1] AS earlier FROM orders, letters),
    met AS (
        SELECT *, fails[filter] AS here, len(list_filter(earlier, lambda x: fails[x])) > 0 AS gone FROM counts, steps)
    SELECT part, list_aggregate(list_transform(o, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') AS filter_order,
           CAST(step AS INTEGER) AS step,
           CAST(coalesce(sum(n) FILTER (NOT here AND NOT gone), 0) AS BIGINT) AS kept,
           CAST(coalesce(sum(n) FILTER (here AND NOT gone), 0) AS BIGINT) AS removed,
           CAST(coalesce(sum(n) FILTER (here AND gone), 0) AS BIGINT) AS redundant,
           CAST(coalesce(sum(n) FILTER (here AND k = 1), 0) AS BIGINT) AS unique_fails,
           CAST(coalesce(sum(good) FILTER (here AND NOT gone), 0) AS BIGINT) AS good_lost,
           CAST(coalesce(sum(toxic) FILTER (here AND NOT gone), 0) AS BIGINT) AS toxic_lost,
           CAST(coalesce(sum(n * 120 // greatest(k, 1)) FILTER (here), 0) AS BIGINT) AS shapley
    FROM met GROUP BY part, o, step"""


@query("op13_weighted_sampling")
def weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.weighted_sampling import compared_with_edits

    return compared_with_edits(table(spark, folder, "documents"))


@query("op12_code_compression")
def code_compression(spark: SparkSession, folder: str) -> DataFrame:
    from stratamart.llm.code_compression import compressed

    return compressed(table(spark, folder, "embeddings"))


def _assigned(k: int) -> str:
    """Parts with the entry of codebook ``k`` that is nearest, and the codebook after them."""
    return f"""
    near{k} AS MATERIALIZED (
        SELECT vec_id, part, min_by(entry, [d, entry]) AS entry, min(d) AS d
        FROM (SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
              FROM parts p JOIN book{k} b USING (part))
        GROUP BY vec_id, part),
    book{k + 1} AS MATERIALIZED (
        SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
        FROM book{k} b LEFT JOIN (
            SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x
            FROM (SELECT part, entry, i, sum(v) AS s, count(*) AS n
                  FROM (SELECT n.part, n.entry, unnest(p.x) AS v, generate_subscripts(p.x, 1) AS i
                        FROM near{k} n JOIN parts p USING (vec_id, part)) GROUP BY part, entry, i)
            GROUP BY part, entry) m USING (part, entry))"""


ORACLE_SQL["op12_code_compression"] = f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, part, x[part * len(x) // 16 + 1 : (part + 1) * len(x) // 16] AS x
        FROM (SELECT vec_id, x, unnest(range(16)) AS part FROM kept)),
    seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
    book0 AS MATERIALIZED (SELECT part, entry, x FROM parts JOIN seeds USING (vec_id)),
    {_assigned(0)}, {_assigned(1)}, {_assigned(2)},
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
        FROM near2 GROUP BY vec_id),
    book AS (SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY part, entry)) AS digest FROM book2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
    FROM coded JOIN kept USING (vec_id) CROSS JOIN book"""
