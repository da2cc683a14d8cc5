"""The registered queries of this folder: ``QUERIES`` and their SQL, ``ORACLES``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    fuzzy_lines, language_mixture, lexical_search, minhash_hamming, page_difference, projection_forest, repeat_index,
    shape_crf, spaced_seeds, temperature_mix, token_alignment, token_lengths, url_digests)
from clickloom.llm.common import table

# The rules of the URL query.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def op1_repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_index.digest(repeat_index.without_repeats(table(spark, sf_dir, "documents")))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir, "documents"))


def op3_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.length_histogram(token_lengths.token_counts(table(spark, sf_dir, "documents")))


def op4_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_difference.main_texts(table(spark, sf_dir, "pages"))


def op5_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_digests.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_hamming.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op8_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temperature_mix.mixture(table(spark, sf_dir, "documents"))


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.removals(table(spark, sf_dir, "documents"))


def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_space_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignments(table(spark, sf_dir, "documents"))


def op13_shape_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_crf.personal_data(table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (
    op1_repeat_index, op2_language_mixture, op3_token_lengths, op4_page_difference, op5_url_digests,
    op6_projection_forest, op7_minhash_hamming, op8_temperature_mix, op9_spaced_seeds, op10_fuzzy_lines,
    op11_block_max_search, op12_space_anchors, op13_shape_crf)}



def _mixture_sql(share: float, parts: int, turns: int, block: int) -> str:
    """The mixture of op8: the exponent by ``turns`` grids of ``parts`` steps, then the passes."""
    steps, low, high = [], "0.0::DOUBLE", "1.0::DOUBLE"
    for k in range(turns):
        bracket = f"SELECT {low} AS lo, {high} AS hi" + (f" FROM e{k - 1}" if k else "")
        steps.append(f"""
        b{k} AS ({bracket}),
        e{k} AS (
            SELECT coalesce(max(a) FILTER (WHERE entropy >= {share}::DOUBLE * ln(n) - 1e-12), 0) AS met,
                   any_value(lo) AS lo, any_value(hi) AS hi
            FROM (SELECT a, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS n,
                         ln(sum(pow(p, a))) - a * sum(pow(p, a) * ln(p)) / sum(pow(p, a)) AS entropy
                  FROM (SELECT tokens / total::DOUBLE AS p FROM src, tot),
                       (SELECT lo, hi, lo + (hi - lo) * i / {parts}::DOUBLE AS a FROM b{k}, range({parts} + 1) AS r(i))
                  GROUP BY a))""")
        low, high = "met", f"least(1.0::DOUBLE, met + (hi - lo) / {parts}::DOUBLE)"
    return f"""
        WITH docs AS (
            SELECT * FROM (
                SELECT doc_id, source, CASE WHEN length(text) > 0 THEN len(string_split(text, ' ')) ELSE 0 END AS n_tokens
                FROM documents) WHERE n_tokens > 0),
        src AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs FROM docs GROUP BY source),
        tot AS (SELECT sum(tokens) AS total FROM src),{",".join(steps)},
        powers AS (SELECT *, pow(tokens / total::DOUBLE, met) AS w FROM src, tot, e{turns - 1}),
        plan AS (
            SELECT source, tokens, CAST(ceil(docs / {block}.0) AS BIGINT) AS blocks,
                   w / sum(w) OVER () * total::DOUBLE / tokens AS passes
            FROM powers),
        uses AS (
            SELECT *, CAST('0x' || substr(key, 1, 8) AS BIGINT) % blocks AS block
            FROM (SELECT d.*, tokens, passes, blocks, epoch,
                         md5(concat_ws('-', coalesce(CAST(doc_id AS VARCHAR), 'null'), CAST(epoch AS VARCHAR))) AS key
                  FROM docs d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source,
                       LATERAL (SELECT unnest(range(CAST(floor(passes) AS BIGINT) + 1)) AS epoch))),
        placed AS (
            SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (
                       PARTITION BY source, epoch ORDER BY block, key, doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place,
                   passes * tokens AS quota
            FROM uses)
        SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epoch AS INTEGER) AS epoch, block,
               round(CAST(place AS DOUBLE) / quota, 6) AS mix_at
        FROM placed WHERE place < quota - 1e-6"""


ORACLES = {
    "op11_block_max_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL),
        docs AS (SELECT row, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0),
        tot AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM docs),
        post AS (
            SELECT row, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
            FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM docs) GROUP BY row, term),
        df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
        q AS (
            SELECT item_id, term, count(*) AS repeats
            FROM (SELECT item_id, unnest(regexp_extract_all(
                             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
            GROUP BY item_id, term),
        scored AS (
            SELECT item_id, row, any_value(doc_id) AS doc_id,
                   sum(repeats * CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1))) AS BIGINT)
                       * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt))))::BIGINT AS score
            FROM q JOIN post USING (term) JOIN df USING (term), tot GROUP BY item_id, row)
        SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
        WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 20""",
    "op8_temperature_mix": _mixture_sql(
        temperature_mix.ENTROPY, temperature_mix.PARTS, temperature_mix.TURNS, temperature_mix.BLOCK_DOCS),
    "op5_url_digests": r"""
        WITH p AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
            FROM pages),
        r(rule, rule_host, rule_path, verdict) AS (VALUES
            ('org/', 'org', '/', 'allow'),
            ('example.org/es/', 'example.org', '/es/', 'block'),
            ('example.org/en/1', 'example.org', '/en/1', 'block'),
            ('com/fr/', 'com', '/fr/', 'allow'),
            ('com/de/', 'com', '/de/', 'block')),
        hit AS (
            SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
            FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host))
                         AND starts_with(path, rule_path)
            GROUP BY page_id)
        SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM p LEFT JOIN hit USING (page_id)""",
}
