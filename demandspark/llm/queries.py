"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm import html_extract, quality
from demandspark.llm.bpe import encode_documents
from demandspark.llm.common import table
from demandspark.llm.drift_clusters import CLUSTERS, ROUNDS, cluster_vectors
from demandspark.llm.embedding_dedup import near_duplicates
from demandspark.llm.exact_dedup import exact_duplicates
from demandspark.llm.jaccard_join import jaccard_components
from demandspark.llm.lm_score import score_documents
from demandspark.llm.mixing import balance
from demandspark.llm.phrase_index import contamination
from demandspark.llm.token_align import align_documents
from demandspark.llm.token_files import read_documents, write_tokens
from demandspark.llm.url_filter import Rule, fit_ratio, judge, seed_labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return register


#: The contract's rules.
URL_RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow")]
#: Words that mark a host as unwanted where nobody labelled URLs by hand.
REJECTED_WORDS = ("ads", "adult", "bet", "bets", "casino", "gambling", "pills", "poker", "porn", "spam", "track", "tracker", "viagra",
                  "warez", "xxx")


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, URL_RULES, fit_ratio(seed_labels(pages, REJECTED_WORDS)))


@query("op2_html_extract")
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_text(pages, html_extract.fit(pages))


def byte_bpe(docs: DataFrame, **options) -> DataFrame:
    """The 50k byte-level vocabulary of the public tokenizer files."""
    import public_tokenizers as public

    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        return encode_documents(docs, lines.read().splitlines(), public.PATTERN, **options)


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


@query("op7_mixing", r"""
    WITH sized AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
               md5(coalesce(CAST(doc_id AS VARCHAR), '') || ' ' || md5(coalesce(text, ''))) AS ord
        FROM documents),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    ranked AS (
        SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight,
               3.0 * source_size AS cap FROM totals),
    levels AS (
        SELECT *, ((SELECT sum(source_size) FROM totals)
                   - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM ranked),
    targets AS (SELECT source, source_size, CAST(least(cap, weight * (SELECT max(level) FROM levels)) AS DOUBLE) AS target FROM levels),
    rates AS (SELECT *, CASE WHEN target > 0 THEN round(target / source_size, 12) ELSE 0.0 END AS rate FROM targets),
    placed AS (
        SELECT s.*, r.source_size, r.target, r.rate,
               sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord ROWS UNBOUNDED PRECEDING) - s.size / 2 AS middle
        FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
    copied AS (
        SELECT *, CASE WHEN size > 0 THEN least(floor(rate) + CAST(middle <= (rate - floor(rate)) * source_size AS INTEGER), 3)
                       ELSE 0 END AS n FROM placed)
    SELECT doc_id, size, source_size, target, CAST(n AS BIGINT) AS copies, CAST(n AS BIGINT) * size AS taken FROM copied
""")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "copies", "taken")


#: The id that ends a document in the contract.
END_ID = 1


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as tokenizer:
        folder, manifest = write_tokens(table(spark, sf_dir, "documents"), tokenizer.read(), END_ID)
    return read_documents(folder, manifest)


@query("op9_exact_dedup", r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, text_sha256
    FROM d WINDOW same AS (PARTITION BY text_sha256)
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op10_embedding_dedup")
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op3_lm_score")
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query("op12_phrase_index", r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents),
    items AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, w[i:i + 9] AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)),
    starts AS (
        SELECT r, i, k, w[i:i + k - 1] AS g
        FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT len(g) AS k FROM windows) WHERE len(w) >= k)),
    found AS (SELECT s.r, s.i, s.k, x.item_id FROM starts s JOIN windows x ON s.g = x.g),
    hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
    listed AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
""")
def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _cluster_sql() -> str:
    """Plain rounds over all vectors and centroids; the last pass only assigns."""
    nearest = """SELECT r, vec_id, q, min({{'d': d, 'c': c}}) AS best
        FROM (SELECT p.r, p.vec_id, p.q, k.c,
                     CAST(list_sum(list_transform(list_zip(p.q, k.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
              FROM kept p, c{0} k) GROUP BY r, vec_id, q"""
    means = """SELECT c, list(m ORDER BY i) AS q
        FROM (SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
              FROM (SELECT best.c AS c, i, sum(q[i]) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{0}, range(1, 65) t(i) GROUP BY best.c, i))
        GROUP BY c UNION ALL SELECT c, q FROM c{0} WHERE c NOT IN (SELECT best.c FROM a{0})"""
    steps = [f"a{i} AS MATERIALIZED ({nearest.format(i)}), c{i + 1} AS MATERIALIZED ({means.format(i)})" for i in range(ROUNDS)]
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = 64),
    c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, q) - 1 AS c, q FROM kept QUALIFY c < {CLUSTERS}),
    {", ".join(steps)}, a{ROUNDS} AS MATERIALIZED ({nearest.format(ROUNDS)})
    SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k.q, ',')) AS centroid_sha256
    FROM a{ROUNDS} a JOIN c{ROUNDS} k ON k.c = a.best.c
    """


@query("op13_drift_clusters", _cluster_sql())
def op13_drift_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def two_tokenizers(docs: DataFrame, **options) -> DataFrame:
    """The byte-level and the piece vocabulary of the public tokenizer files."""
    import public_tokenizers as public

    with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public.path("piece_bpe_32k.model"), "rb") as b:
        return align_documents(docs, a.read(), b.read(), **options)


@query("op11_token_align")
def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_tokenizers(table(spark, sf_dir, "documents"))
