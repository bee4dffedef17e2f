"""Corpus pipeline over the documents table: toxicity filter, near-duplicate filter,
personal data redaction, packing.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame, which run() writes as Parquet and rereads as the next stage's docs. All but
the last return the columns of documents. Null texts count as empty; an empty table goes
through every stage; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import jaccard, packing, pii, toxicity
from ordermart.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"), "text")
    scored = toxicity.score(whole, model, "whole", "text")
    return scored.where(F.col("score") < toxicity.LIMIT).select("whole.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest doc_id (null ids last).
    Rows, not ids, are joined and dropped, so repeated and null ids take no other text along."""
    row = next(n for n in ("row", *(f"row{k}" for k in range(len(docs.columns)))) if n.lower() not in map(str.lower, docs.columns))
    keyed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    found = jaccard.near_duplicates(keyed, row).select(row, F.col("component_id").alias("_group"))
    several = found.where(F.col(row) != F.col("_group")).select("_group").distinct()
    members = stored(found.join(several, "_group", "left_semi"), "members")
    ids = members.join(keyed.select(row, F.col("doc_id").alias("_id")), row)
    stays = ids.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull(), "_id", row)).alias("_first")).select("_group", F.col(f"_first.{row}").alias("_stays"))
    gone = stored(members.join(stays, "_group").where(F.col(row) != F.col("_stays")).select(row), "gone")
    few = gone.count() <= jaccard.IDS
    return keyed.join(F.broadcast(gone) if few else gone, row, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind; n_chars follows."""
    text = pii.redacted(F.coalesce("text", F.lit("")))
    changed = docs.withColumn("text", F.when(F.col("text").isNotNull(), text))
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("pii", redact), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Tokenization and the models have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None
