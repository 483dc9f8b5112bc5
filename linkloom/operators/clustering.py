"""Clusters of URLs of one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _parts(url: Column) -> Column:
    return F.split(F.regexp_replace(url, "/$", ""), "/")


def url_labels(url: Column) -> list[tuple[Column, bool]]:
    """The labels by which URLs are told apart, one after the other, each with whether labels of
    one URL only are pooled: slashes, query tokens, host, path segments, the last one."""
    parts = _parts(F.regexp_replace(url, r"\?.*$", ""))
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "[&=]")
    part = lambda i: F.coalesce(F.nullif(F.get(parts, F.lit(i)), F.lit("")), F.nullif(F.get(parts, F.lit(3)), F.lit("")), F.lit("0"))
    tokens = [(F.coalesce(F.get(query, F.lit(i)), F.lit("")), True) for i in range(3)]
    return [
        (F.size(parts).cast("string"), False), *tokens, (F.coalesce(F.get(parts, F.lit(2)), F.lit("")), False),
        *[(part(i), True) for i in range(3, 11)], (F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")), True),
    ]


def cluster_urls(links: DataFrame, url: str = "url") -> DataFrame:
    """(url, kind, cluster) of each distinct URL. kind: number (the first path segment is a number),
    short (a plain URL of one segment), deep, or alone. cluster is null for URLs on their own.

    Deep URLs are grouped label by label; where a label has one URL in its group, it is pooled with
    the others of that sort. What remains alone is grouped with the short ones by
    first segment. The labels are one chain of windows, gone through once."""
    rows = links.select(F.col(url).alias("url")).where("url is not null").distinct()
    parts = F.split(F.col("url"), "/")
    first = F.coalesce(F.get(parts, F.lit(3)), F.lit(""))
    plain = ~F.col("url").contains("?")
    short = plain & (((F.size(parts) <= 4) & (F.length(first) > 0)) | ((F.size(parts) <= 5) & F.col("url").endswith("/")))
    rows = rows.withColumn("kind", F.when(first.rlike("^[0-9]+$"), "number").when(short, "short").otherwise("deep")).withColumn("segment", first)
    deep = rows.where("kind = 'deep'").withColumn("path", F.lit(""))
    for label, pooled in url_labels(F.col("url")):
        deep = deep.withColumn("label", label)
        if pooled:
            n = F.count(F.lit(1)).over(Window.partitionBy("path", "label"))
            deep = deep.withColumn("label", F.when(n > 1, F.col("label")).otherwise("oldLabel"))
        deep = deep.withColumn("path", F.md5(F.concat_ws("/", "path", "label")))
    deep = deep.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("path")))
    deep = deep.select("url", "segment", F.when(F.col("size") > 1, F.concat(F.lit("deep:"), "path")).alias("path"))
    # Groups of deep URLs, and the short ones with the deep ones that are left over by segment.
    small = rows.where("kind = 'short'").select("url", "segment", F.lit(None).cast("string").alias("path"))
    both = deep.unionByName(small).withColumn("cluster", F.coalesce("path", F.concat(F.lit("short:"), "segment")))
    many = F.count(F.lit(1)).over(Window.partitionBy("cluster")) > 1
    kind = F.when(F.col("path").isNotNull(), "deep").when(F.col("many"), "short").otherwise("alone")
    both = both.withColumn("many", many).select("url", kind.alias("kind"), F.when(F.col("many"), F.col("cluster")).alias("cluster"))
    # All numbers are one cluster: their count combines in each task.
    numbers = rows.where("kind = 'number'")
    some = numbers.agg(F.count(F.lit(1)) > 1).scalar()
    numbers = numbers.select("url", F.when(some, "number").otherwise("alone").alias("kind"), F.when(some, F.lit("number")).alias("cluster"))
    return both.unionByName(numbers)
