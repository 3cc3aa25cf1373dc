"""Shuffling a corpus that no memory holds, in two passes, into shards of equal row counts.

Pass one scatters rows evenly into buckets of about ``BUCKET_BYTES`` by a seeded hash. Pass two takes
one bucket at a time into memory, orders it by content, permutes it by a seeded Fisher-Yates shuffle
and writes it. The buckets in order are one random order of all rows; shards are equal runs of it,
cut by a manifest with one row for each bucket, so no row moves again.

The hash takes doc_id, a checksum of the text and the number of the input partition. Rows that agree
in all columns therefore spread as well: a bucket gets at most what the input partitions that hash
into it hold. The input's split must not change between attempts, which holds for files.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmetrics.session import work_folder

SHARDS = 16
SEED = 20
BUCKET_BYTES = 16 << 20
OWN = ("_bucket", "_place", "_size", "_crc", "_begin", "_all", "shard", "slot")


def shuffle_to_files(df: DataFrame, path: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Both passes; the files hold all columns of ``df`` (it must have doc_id and text) and the places.

    Columns with one of the names in ``OWN``, in either case, are refused.
    """
    clash = set(OWN) & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")
    # Bytes of text and one more for each row, the size by which rows are counted.
    total = df.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    scattered = df.select(
        "*",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("_size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_crc"),
    ).withColumn(
        "_bucket",
        F.pmod(F.xxhash64("doc_id", "_crc", F.spark_partition_id(), F.lit(seed)), F.lit(buckets)).cast("int"),
    )
    out = T.StructType([*scattered.schema.fields, T.StructField("_place", T.LongType())])

    def permute(table: pa.Table) -> pa.Table:
        bucket = table.column("_bucket")[0].as_py()
        table = table.sort_by([("doc_id", "ascending"), ("_crc", "ascending")])
        order = fisher_yates(table.num_rows, seed, bucket)
        return table.take(pa.array(order)).append_column("_place", pa.array(np.arange(table.num_rows), pa.int64()))

    scattered.groupBy("_bucket").applyInArrow(permute, out).write.parquet(path)


def fisher_yates(n: int, seed: int, bucket: int) -> list[int]:
    """A uniform permutation of range(n): each place from the last down swaps with one at or before it."""
    order = list(range(n))
    picks = (np.random.default_rng([seed, bucket]).random(n) * np.arange(1, n + 1)).astype(np.int64).tolist()
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def read_shards(spark: SparkSession, path: str, shards: int = SHARDS) -> DataFrame:
    """The shuffled rows with ``shard`` and ``slot``; shard counts are at most one apart."""
    files = spark.read.parquet(path)
    manifest = files.groupBy("_bucket").agg(F.count("*").alias("n")).select(
        "_bucket",
        (F.sum("n").over(Window.orderBy("_bucket")) - F.col("n")).alias("_begin"),
        F.sum("n").over(Window.partitionBy()).alias("_all"),
    )
    place = F.col("_begin") + F.col("_place")
    return (
        files.join(manifest, "_bucket")
        .withColumn("shard", F.expr(f"CAST((_begin + _place) * {shards} DIV _all AS int)"))
        .withColumn("slot", place - F.expr(f"(shard * _all + {shards - 1}) DIV {shards}"))
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """A folder for each shard, from what :func:`read_shards` gives; each file keeps the shuffled order."""
    columns = [c for c in shuffled.columns if c in ("shard", "slot") or c not in OWN]
    shuffled.sortWithinPartitions("shard", "slot").select(*columns).write.partitionBy("shard").parquet(path)


def shard_documents(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row, through shuffled files.

    Null texts have size 1 and the checksum of no bytes; null and repeated doc_ids stay. An empty table
    gives no rows. Equal texts may part; the law is ``rows``, so grown_shard is null. Other columns are
    not read.
    """
    spark = df.sparkSession
    path = work_folder(spark, "shuffled")
    shuffle_to_files(df.select("doc_id", "text"), path, seed)
    return read_shards(spark, path, shards).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
