"""The registered queries of this package: thin calls of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import table
from feedloom.llm.exact import exact_groups
from feedloom.llm.fingerprints import fingerprints
from feedloom.llm.html import extracted
from feedloom.llm.jaccard import similar_documents
from feedloom.llm.merkle import document_manifest
from feedloom.llm.mixing import mix_counts
from feedloom.llm.neighbours import nearest
from feedloom.llm.packing import pack
from feedloom.llm.privacy import personal_data, personal_data_digest
from feedloom.llm.quality import quality_scores
from feedloom.llm.spelling import spelling_variants
from feedloom.llm.toxicity import toxicity_scores
from feedloom.llm.urls import url_verdicts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with SQL of the same result if there is any."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


@query(
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), largest=True)


@query()
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), k=3, percent=90)


@query()
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents"))


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


@query()
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


@query()
def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


@query()
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(personal_data(table(spark, sf_dir, "documents")))


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


#: crc32 of the list ``bytes``, byte by byte over a table made from its polynomial.
CRC = """crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crcs)"""
CRC_OF = """xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes}::BIGINT[]),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)"""


@query(
    f"""WITH RECURSIVE {CRC}, raw AS (
        SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
    ), runs AS (SELECT doc_id, w, count(*) AS k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM raw GROUP BY ALL),
    hashed AS (SELECT w, k, {CRC_OF.format(bytes="list_transform(range(strlen(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT)")} AS h FROM runs, crc_table),
    cut AS (SELECT CASE WHEN h % 31 = 0 THEN w[:(h % length(w))::INT] || w[(h % length(w))::INT + 2:] ELSE w END AS word, k FROM hashed),
    words AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
    parts AS (SELECT word, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    pairs AS (
        SELECT a.word AS word, b.word AS near FROM parts a JOIN parts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT p.word, w.word FROM parts p JOIN words w ON p.rest = w.word
        UNION SELECT w.word, p.word FROM parts p JOIN words w ON p.rest = w.word
    ), ranked AS (
        SELECT pairs.word, near, n, count(*) OVER (PARTITION BY pairs.word) AS n_near,
        row_number() OVER (PARTITION BY pairs.word ORDER BY n DESC, near) AS r FROM pairs JOIN words ON words.word = near
    ), forms AS (
        SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN ranked.n >= 10 * words.n THEN near END AS form,
        CASE WHEN ranked.n >= 10 * words.n THEN ranked.n END AS form_n
        FROM words LEFT JOIN ranked ON ranked.word = words.word AND r = 1
    ), chain AS (
        SELECT word, form, word AS root FROM forms
        UNION ALL SELECT chain.word, forms.form, forms.word FROM chain JOIN forms ON forms.word = chain.form
    )
    SELECT forms.word, forms.form, chain.root, n, n_near, form_n FROM forms JOIN chain ON chain.word = forms.word AND chain.form IS NULL"""
)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"


@query(
    f"""WITH RECURSIVE {CRC}, leaves AS (
        SELECT doc_id, lang, {_LEAF.format(text="text")} AS leaf, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS p,
        {CRC_OF.format(bytes="list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ord((doc_id::VARCHAR)[i + 1]))")} % 3 = 0 AS hit,
        {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS changed
        FROM documents, crc_table
    ), tree AS (
        SELECT g, 0 AS lvl, p, leaf AS h FROM leaves
        UNION ALL SELECT g, lvl + 1, p // 8, sha256(string_agg(h, '' ORDER BY p))
        FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM tree) WHERE n > 1 GROUP BY g, lvl, p // 8
    ), heights AS (SELECT g, max(lvl) AS height FROM tree GROUP BY g),
    subroots AS (SELECT tree.g, height, h AS subroot FROM tree JOIN heights ON heights.g = tree.g AND lvl = height),
    top AS (
        SELECT 0 AS lvl, g AS p, subroot AS h FROM subroots
        UNION ALL SELECT lvl + 1, p // 8, sha256(string_agg(h, '' ORDER BY p))
        FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY lvl, p // 8
    ), peak AS (SELECT lvl AS height, h AS root FROM top ORDER BY lvl DESC LIMIT 1),
    fold AS (
        SELECT g, p, 0 AS lvl, p AS at, CASE WHEN hit THEN changed ELSE leaf END AS h, '' AS proof FROM leaves
        UNION ALL SELECT f.g, f.p, f.lvl + 1, f.at // 8, sha256(string_agg(CASE WHEN t.p = f.at THEN f.h ELSE t.h END, '' ORDER BY t.p)),
        f.proof || coalesce(string_agg(t.h, '' ORDER BY t.p) FILTER (WHERE t.p <> f.at), '')
        FROM fold f JOIN heights USING (g) JOIN tree t ON t.g = f.g AND t.lvl = f.lvl AND t.p // 8 = f.at // 8
        WHERE f.lvl < height GROUP BY f.g, f.p, f.lvl, f.at, f.h, f.proof
    ), upward AS (
        SELECT fold.g, p, 0 AS lvl, fold.g AS at, h, proof FROM fold JOIN heights ON heights.g = fold.g AND lvl = height
        UNION ALL SELECT f.g, f.p, f.lvl + 1, f.at // 8, sha256(string_agg(CASE WHEN t.p = f.at THEN f.h ELSE t.h END, '' ORDER BY t.p)),
        f.proof || coalesce(string_agg(t.h, '' ORDER BY t.p) FILTER (WHERE t.p <> f.at), '')
        FROM upward f JOIN top t ON t.lvl = f.lvl AND t.p // 8 = f.at // 8
        WHERE f.lvl < (SELECT height FROM peak) GROUP BY f.g, f.p, f.lvl, f.at, f.h, f.proof
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
    FROM leaves JOIN subroots USING (g) JOIN peak ON true JOIN upward ON upward.g = leaves.g AND upward.p = leaves.p AND upward.lvl = peak.height"""
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(table(spark, sf_dir, "documents"))
