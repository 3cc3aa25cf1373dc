"""The corpus pipeline: documents through five stages, each written before the next reads it.

toxicity        drops documents predicted toxic
ngram_join      keeps, of each group of near copies (five words, 0.8), the row of the smallest doc_id, nulls last,
                and of several such the one of the smallest text
decontaminate   drops rows that hold a benchmark passage
secrets         replaces secrets in the text; n_chars follows
pieces          encodes and decodes what is left

All but the last return the columns they were given, whatever names others than doc_id and text have. Rows that agree in doc_id and text count as
one document. A null text is an empty one and stays until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickmetrics.llm import decontaminate, ngram_join, secret_scan, sentence_pieces, toxicity
from clickmetrics.llm.common import keep_files
from clickmetrics.llm.queries import table
from clickmetrics.session import work_folder


def _rows(docs: DataFrame) -> DataFrame:
    """A row as a whole, with the two columns that operators read: no other name can meet one of theirs."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.score_rows(docs, model).where("score < 0.5").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _rows(docs)
    linked = ngram_join.link_rows(rows, n=5, percent=80).groupBy("doc_id", "text_key", "component").agg(F.count("*").alias("rows"))
    # Of a component stays one row, of the smallest doc_id and then the smallest text; null ids come last.
    # Rows without words are no copies of anything.
    linked = keep_files(spark, linked, "linked")
    least = linked.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    kept = linked.join(least, "component", "left").where("component IS NULL OR doc_id <=> least")
    kept = kept.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "component", "rows")
    lone = F.col("component").isNull()
    alike = ["component", F.when(lone, F.col("id")), F.when(lone, F.col("key"))]
    left = F.sum("rows").over(Window.partitionBy(*alike))
    kept = keep_files(spark, kept.withColumn("left", left).drop("rows"), "kept")
    keyed = rows.withColumn("own_key", F.xxhash64("text"))
    mine = keyed.join(kept, F.expr("CAST(doc_id AS bigint)").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")))
    # Only rows that others could replace are grouped; the rest, nearly all, have moved once.
    one = mine.where("left > 1").groupBy(*alike).agg(F.min_by("row", F.struct(F.coalesce("text", F.lit("")))).alias("row"))
    return mine.where("left = 1").select("row").unionByName(one.select("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_hits(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact_texts(docs)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("pieces", encode),
]

# Subsequence kernels and sentence pieces have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
