"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.llm import (
    bpe,
    decontaminate,
    language,
    licenses,
    merkle,
    minhash,
    negatives,
    pages,
    prefixes,
    quality,
    repetition,
    substrings,
    warc,
)
from scorewatch.llm.graph import stage
from scorewatch.plans.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def remainder(n: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string")) % n


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = stage(warc.write_archives(warc.plan(table(spark, sf_dir, "pages"))), "archives")
    read = warc.read_records(stage(warc.normalise(written), "normalised"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.deduplicate(table(spark, sf_dir, "documents"))
    words = F.trim(F.regexp_replace(F.coalesce("kept", F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " "))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), TOKENIZER)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(4) == 2
    model = language.fit(docs, ~held_out)
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"), remainder(5) == 0, framed=False)


@query
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.edits(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


ORACLES["op3_warc"] = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN f.first IS NULL OR f.first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first <> page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)"""

def leak_sql() -> str:
    """Seeds, offsets and stretches in SQL, on words where the operator takes hashes."""

    def seeds(table: str, key: str) -> str:
        span = decontaminate.SPAN
        spaced = [
            f"SELECT {key}, spot, {m} AS mask, concat_ws(' ', {', '.join(f'w[spot + {k}]' for k in mask)}) AS seed "
            f"FROM (SELECT {key}, w, unnest(range(1, len(w) - {span} + 2)) AS spot FROM {table} WHERE len(w) >= {span})"
            for m, mask in enumerate(decontaminate.MASKS)
        ]
        whole = f"SELECT {key}, 1 AS spot, -len(w) AS mask, array_to_string(w, ' ') AS seed FROM {table}"
        if table == "i":
            return " UNION ALL ".join([*spaced, f"{whole} WHERE len(w) < {span}"])
        short = [
            f"SELECT {key}, spot, {-n} AS mask, array_to_string(list_slice(w, spot, spot + {n - 1}), ' ') AS seed "
            f"FROM (SELECT {key}, w, unnest(range(1, len(w) - {n} + 2)) AS spot FROM {table} WHERE len(w) >= {n})"
            for n in range(decontaminate.ALONE, span)
        ]
        return " UNION ALL ".join([*spaced, *short, f"{whole} WHERE len(w) < {decontaminate.ALONE}"])

    words = r"regexp_extract_all(lower(text), '[^ \t\n\x0B\f\r]+') AS w"
    return f"""
WITH d AS (SELECT doc_id, {words} FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT DISTINCT item_id, {words} FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
di AS ({seeds("d", "doc_id")}),
ii AS ({seeds("i", "item_id")}),
hits AS (SELECT DISTINCT doc_id, item_id, di.spot - ii.spot AS shift FROM di JOIN ii USING (mask, seed)),
pairs AS (
  SELECT doc_id, item_id, shift, d.w AS x, i.w AS y, unnest(range(1, len(i.w) + 1)) AS k
  FROM hits JOIN d USING (doc_id) JOIN i USING (item_id)),
same AS (
  SELECT doc_id, item_id, shift, len(y) AS n, k, row_number() OVER (PARTITION BY doc_id, item_id, shift, y ORDER BY k) AS r, y
  FROM pairs WHERE k + shift BETWEEN 1 AND len(x) AND x[k + shift] = y[k]),
stretches AS (
  SELECT doc_id, item_id, shift, y, a.n, z.r - a.r + 1 AS equal, z.k - a.k + 1 AS size, a.k + shift - 1 AS place
  FROM same a JOIN same z USING (doc_id, item_id, shift, y)
  WHERE z.r >= a.r AND 100 * (z.r - a.r + 1) >= {decontaminate.PERCENT} * (z.k - a.k + 1)
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift, y ORDER BY z.r - a.r DESC, z.k - a.k, a.k) = 1)
SELECT doc_id, item_id, equal AS matched_words, size AS compared_words, place AS first_word FROM stretches
WHERE equal >= least({decontaminate.LEAST}, n)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, y ORDER BY equal DESC, place, size DESC) = 1"""


ORACLES["op5_decontamination"] = leak_sql()

# The windows' words themselves are compared, where the operator takes hashes of 96 bits.
ORACLES["op7_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS k FROM d),
begun AS (
  SELECT doc_id, k, x, CASE WHEN count(*) OVER ahead = 13 THEN string_agg(x, ' ') OVER ahead END AS words FROM word
  WINDOW ahead AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
owned AS (
  SELECT doc_id, k, x, words IS NOT NULL AND min(doc_id) OVER (PARTITION BY words) < doc_id AS repeated FROM begun),
covered AS (
  SELECT doc_id, k, x, bool_or(repeated) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM owned)
SELECT doc_id, count(k) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(x, ' ' ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN covered USING (doc_id) GROUP BY doc_id"""

ORACLES["op13_hard_negatives"] = """
WITH raw AS (
  SELECT vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM raw a JOIN raw b ON a.id % 100 = 0 AND a.id <> b.id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 5"""
