"""Seed and queue sources and sinks: text files, tables, message logs."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import ascii_hosts, form_preference, url_forms, url_key


def seed_file(spark: SparkSession, path: str) -> DataFrame:
    """(key, url): the URLs of a text file, one a line, spellings of one page as one."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(ascii_hosts(F.trim("value")).alias("url"))
    return lines.select(url_forms(F.col("url")).alias("f")).groupBy(F.col("f.key").alias("key")).agg(F.min_by("f.normal", form_preference(F.col("f"))).alias("url"))


def json_array_file(spark: SparkSession, path: str) -> list[str]:
    """The strings of a JSON array file, such as a vocabulary; none if it can't be read as one."""
    try:
        values = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))
    except Exception as e:  # a missing file is an AnalysisException, a broken one a ValueError
        if type(e).__name__ not in ("AnalysisException", "JSONDecodeError"):
            raise
        return []
    return [v for v in values if isinstance(v, str)] if isinstance(values, list) else []


def seed_table(df: DataFrame, url: str = "careerUrl", mark: str = "redisSeeded", include_seeded: bool = False, most: int | None = None, key: str = "id") -> DataFrame:
    """Rows with a URL that bear no mark yet; the first `most` by key, if given."""
    rows = df.where(F.col(url).isNotNull() & (F.trim(url) != ""))
    if not include_seeded and mark in df.columns:
        rows = rows.where(~F.coalesce(F.col(mark), F.lit(False)))
    return rows.orderBy(key).limit(most) if most else rows


def with_marks(df: DataFrame, seeded: DataFrame, now, key: str = "id", mark: str = "redisSeeded", marked_at: str = "redisSeededAt") -> DataFrame:
    """df with the marks set on the rows whose key is in seeded."""
    keys = seeded.select(F.col(key)).distinct().withColumn("__new", F.lit(True))
    out = df.join(keys, key, "left")
    old, old_at = (F.col(c) if c in df.columns else F.lit(None) for c in (mark, marked_at))
    return out.withColumns({mark: F.coalesce("__new", old, F.lit(False)), marked_at: F.when(F.col("__new"), now).otherwise(old_at)}).drop("__new")


def seed_batch(table: DataFrame, now, done: DataFrame | None = None, queue_length: int | None = None, include_seeded: bool = False, most: int | None = None, key: str = "id", url: str = "careerUrl", mark: str = "redisSeeded") -> tuple[DataFrame, DataFrame]:
    """(queue, table) of one cycle of seeding: the preferred spelling of each new URL as (key, url), and
    the table with its marks. An empty queue (queue_length 0) starts over: marked seeds count, and
    those of completed pages, done (url), don't. `most` rows at most, by key."""
    again = queue_length == 0
    rows = seed_table(table, url, mark, include_seeded or again, most, key)
    forms = rows.select(url_forms(F.col(url)).alias("f")).where("f.normal <> ''")
    queue = forms.groupBy(F.col("f.key").alias("key")).agg(F.min_by("f.normal", form_preference(F.col("f"))).alias("url"))
    if done is not None:
        queue = queue.join(done.select(url_key(F.col("url")).alias("key")).distinct(), "key", "left_anti")
    return queue, table if include_seeded or again else with_marks(table, rows, now, key, mark)


def choose_seed_table(tables: Sequence[tuple[str, DataFrame]], url: str = "careerUrl", mark: str = "redisSeeded") -> tuple[str, str]:
    """(name, reason) of the first table with an unmarked seed, else with any, else the first.

    Each test reads at most one row."""
    for name, df in tables:
        if not seed_table(df, url, mark).limit(1).isEmpty():
            return name, "unseeded"
    for name, df in tables:
        if not df.where(F.col(url).isNotNull()).limit(1).isEmpty():
            return name, "has_urls"
    return tables[0][0], "default"


def append_messages(df: DataFrame, path: str) -> None:
    """Append messages (id, value) to a log; values that are no strings become JSON."""
    value = F.col("value") if df.schema["value"].dataType.simpleString() == "string" else F.to_json("value")
    df.select("id", value.alias("value")).write.mode("append").parquet(path)


def log_length(spark: SparkSession, path: str) -> int:
    """How many messages a log holds; 0 where there is none yet."""
    try:
        return spark.read.parquet(path).count()
    except Exception as e:
        if type(e).__name__ != "AnalysisException":
            raise
        return 0


def health_report(snapshot: DataFrame) -> DataFrame:
    """A health snapshot as one JSON string for each row."""
    return snapshot.select(F.to_json(F.struct("*")).alias("report"))
