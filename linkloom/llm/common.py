"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import json
import math
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..sources.folders import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, n: int, *others: str) -> list[str]:
    """n column names that neither df has, in any case of letters, nor are among others."""
    known = {c.lower() for c in (*df.columns, *others)}
    return [x for x in (f"__c{i}" for i in range(n + len(known))) if x not in known][:n]


def give_back() -> None:
    """Return freed memory of this Python process to the system: workers are used again by later
    stages, and would hold on to what the largest one took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def tidied(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f, for mapInArrow, with give_back() at the end of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame, frees: tuple[DataFrame, ...] = ()) -> DataFrame:
    """df written as a table in the shared folder that spark.checkpoint.dir names, and read again.

    This cuts the lineage, and lets plans go by the real size: an iterated checkpoint() would
    carry on the estimates of its joins, which multiply. The shuffle files of the write go
    with it, and so do the tables `frees`, earlier results of this function that nothing
    needs after df is written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/linkloom-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    dropped(*frees)
    out = spark.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete what checkpointed() wrote for these; nothing that is still to run may read them.
    Shuffle files that only the driver's garbage still holds go as well."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.table_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        tables[0].sparkSession._jvm.System.gc()


#: A key is frequent where it has more than one in so many rows; so there are fewer such keys than that.
FREQUENT = 1000


def looked_up(left: DataFrame, right: DataFrame, on: str, count: str) -> DataFrame:
    """The rows of left joined with right, a written table with one row for each value of `on`
    and in `count` how many rows of left have it. Null keys join nothing.

    Keys that are frequent, fewer than FREQUENT of them, are sent to where left's rows
    are, so the rows of one key never meet in one task; all others are joined by a shuffle."""
    total = right.agg(F.sum(count)).first()[0] or 0
    many = F.col(count) > total // FREQUENT
    hot = right.where(many)
    near = left.join(F.broadcast(hot), on)  # fewer than FREQUENT rows
    rest = left.join(F.broadcast(hot.select(on)), on, "left_anti").join(right.where(~many).hint("merge"), on)
    return near.unionByName(rest).drop(count)


def sort_bounds(df: DataFrame, key: str, parts: int, per_part: int = 40) -> list:
    """At most parts - 1 cut points that deal the keys out evenly. A key is a struct that ends in a
    hash of its row, so that rows of one value, or without one, are dealt out as well.

    They come from a sample of about parts * per_part keys, however large df is; rows
    beyond the sample are still placed exactly, the sample only sets how even the parts are."""
    keys = df.select(key)
    n = keys.count()
    want = parts * per_part
    if n > want:
        keys = keys.sample(False, min(1.0, want / n), seed=11)
    got = [r[0].asDict() for r in keys.orderBy(key).collect()]
    cuts = [got[len(got) * i // parts] for i in range(1, parts)] if got else []
    return [x for i, x in enumerate(cuts) if not i or x != cuts[i - 1]]


@F.pandas_udf(BinaryType())
def packed(texts: pd.Series) -> pd.Series:
    """Texts compressed without loss; null as the empty text."""
    pack = zstandard.ZstdCompressor(level=3)
    return texts.map(lambda t: pack.compress((t or "").encode("utf-8", "surrogatepass")))


def bucket_of(key: Column, bounds: list, kind: str) -> Column:
    """How many of the sorted bounds (structs of the SQL type kind) are at or below key.

    Bounds are looked at in two steps, whole blocks and then within one, so a row costs
    about twice the root of their number."""
    step = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    held = F.from_json(F.lit(json.dumps([*blocks, []])), f"array<array<{kind}>>")
    lasts = F.from_json(F.lit(json.dumps([b[-1] for b in blocks])), f"array<{kind}>")
    below = lambda x: x <= key
    skipped = F.size(F.filter(lasts, below))
    found = skipped * step + F.size(F.filter(F.get(held, skipped), below))
    return F.least(found, F.lit(len(bounds))).cast("int")


def with_next(df: DataFrame, key: str, payload: Column, wrap: bool) -> DataFrame:
    """Rows (part, key, payload, own), to be read sorted within each partition by part and key:
    in a part, each own row comes after the row with the next smaller key.

    The parts are ranges of keys of about equal size; rows of one key, or without one, spread over
    several parts. The greatest row of a part is also
    given, as not own, to the next part that has rows; with wrap the greatest row of all
    goes to the first part. Null keys come first."""
    spark = df.sparkSession
    # Rows of one key are told apart by a hash, so that their order is fixed.
    keyed = df.withColumn("rank", F.struct(F.col(key), F.xxhash64(*df.columns).alias("h")))
    bounds = sort_bounds(keyed, "rank", 4 * shuffle_partitions(spark))
    keyed = keyed.withColumn("part", bucket_of(F.col("rank"), bounds, keyed.schema["rank"].dataType.simpleString()))
    rank = F.col("rank")
    tops = keyed.groupBy("part").agg(F.max(rank).alias("top")).orderBy("part").collect()  # one row for each part
    following = {a["part"]: b["part"] for a, b in zip(tops, tops[1:], strict=False)}
    if wrap and tops:
        following[tops[-1]["part"]] = tops[0]["part"]
    rows = [(r["part"], r["top"][0], r["top"][1], following.get(r["part"])) for r in tops]
    kind = df.schema[key].dataType.simpleString()
    last = spark.createDataFrame(rows, f"part int, k {kind}, h bigint, to int")
    last = last.where("to is not null")
    tagged = keyed.select("part", "rank", payload.alias("payload")).join(F.broadcast(last), "part", "left")  # as many rows as parts
    extra = F.when(F.col("rank").eqNullSafe(F.struct(F.col("k"), F.col("h"))), F.col("to"))
    places = F.filter(F.array(F.struct(F.col("part").alias("part"), F.lit(True).alias("own")), F.struct(extra.alias("part"), F.lit(False).alias("own"))), lambda x: x["part"].isNotNull())
    out = tagged.select(F.explode(places).alias("place"), "rank", "payload")
    out = out.select("place.part", "place.own", "rank", "payload")
    # A row that its own part follows stands before that part's rows.
    return out.repartition(shuffle_partitions(spark), "part").sortWithinPartitions("part", "own", "rank")
