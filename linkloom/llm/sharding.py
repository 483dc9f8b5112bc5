"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records into buckets of bounded bytes by a seeded hash. Pass 2 runs
the Fisher-Yates shuffle inside each bucket (the built-in `shuffle` with a fixed seed). The
buckets, one after the other, are the shuffled sequence; the shards are equal runs of it,
so shard counts differ by one at most (law `rows`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shuffle_partitions, unused


def shuffled_positions(df: DataFrame, size: str, seed: int = 17, bucket_bytes: int = 64 << 20) -> DataFrame:
    """df's rows with `position`: their place, from 0, in one seeded random order of all rows.

    size: a column with each row's bytes. Every row keeps all its columns and travels with them,
    so project first what the order alone needs. A bucket holds about bucket_bytes, or less
    where that keeps all tasks busy; its rows are the most a task holds at once.

    Rows are scattered by the seeded hash of their place in the scan, which is why copies, one
    frequent key or nulls never meet in one bucket. The input has to replay in the same
    order, as a table scan does. An empty input gives no rows; nulls in any column are kept."""
    spark = df.sparkSession
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(-(-int(total) // bucket_bytes), shuffle_partitions(spark))
    names = df.columns
    rows = df.select(
        F.struct(F.monotonically_increasing_id().alias("at"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).alias("item")
    )
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("item.at")), F.lit(buckets)))
    held = rows.groupBy("bucket").agg(F.collect_list("item").alias("items"), F.count(F.lit(1)).alias("n"))
    # The sort makes what shuffle() sees the same in every attempt: it draws from one
    # generator for each partition, seeded with the seed and the partition's number.
    held = held.withColumn("items", F.array_sort("items")).sortWithinPartitions("bucket")
    held = held.select("bucket", "n", F.shuffle(F.col("items"), F.lit(seed)).alias("items"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # One row for each bucket: buckets grow with the bytes, but a bucket is 64 MB.
    offsets = sizes.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("offset"))
    placed = held.join(offsets, "bucket").select("offset", F.posexplode("items").alias("at", "item"))
    return placed.select((F.col("offset") + F.col("at")).alias("position"), "item.row.*")


def assign_shards(df: DataFrame, size: str, shards: int = 40, seed: int = 17, bucket_bytes: int = 64 << 20) -> DataFrame:
    """df's rows with shard, slot (from 0 in each shard, without gaps) and law.

    Shard k gets the positions from ceil(k * n / shards) on; with fewer rows than shards
    some shards stay empty. Columns of df named position, shard, slot or law are replaced."""
    df = df.drop("position", "shard", "slot", "law")
    n = max(df.count(), 1)
    at = shuffled_positions(df, size, seed, bucket_bytes)
    at = at.withColumn("shard", F.expr(f"position * {shards} div {n}").cast("int"))
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return at.withColumn("slot", (F.col("position") - first).cast("long")).withColumn("law", F.lit("rows")).drop("position")


def write_shards(df: DataFrame, path: str, text: str = "text", shards: int = 40, seed: int = 17, file_bytes: int = 256 << 20) -> None:
    """Write df as Parquet, a folder for each shard. A shard is written by several tasks, each a run of
    its slots of about file_bytes; rows are in slot order within a file, and the slot is kept."""
    size = unused(df, 1)[0]
    sized = df.withColumn(size, F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16)
    files = max(shards, int(sized.agg(F.sum(size)).first()[0] or 0) // file_bytes)
    out = assign_shards(sized, size, shards, seed).drop(size)
    out.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 39: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = assign_shards(docs, "size")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
