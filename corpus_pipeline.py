"""From raw documents to token ids: filter, deduplicate twice, decontaminate, encode.

Every stage takes (spark, docs, sf_dir) and works on all rows of its predecessor. All but the
last return the columns of documents. Nulls, empty texts, ties, repeated rows and clashing
columns are treated as the operators' modules say; what a stage adds to that stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewatch.llm import bpe, decontaminate, minhash, quality, substrings
from scorewatch.llm.graph import stage
from scorewatch.llm.queries import TOKENIZER, remainder
from scorewatch.plans.registry import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. Empty ones are scored like others."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return quality.keep(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Rows of
    one id stay or go together; those without an id stay."""
    found = minhash.near_duplicates(docs)
    gone = found.where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document has too; n_chars follows the text. No row goes."""
    kept = substrings.deduplicate(docs)
    columns = {c: F.col(f"rest.`{c}`") for c in docs.columns if c not in ("doc_id", "text")}
    columns |= {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept")}
    if "n_chars" in columns:
        changed = F.length("kept").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_removed") > 0, changed).otherwise(columns["n_chars"])
    return kept.select(*(columns[c].alias(c) for c in docs.columns))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item; rows without an id stay."""
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"))
    gone = found.select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to."""
    return bpe.encode_texts(docs, TOKENIZER).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminated),
    ("bpe", encoded),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
