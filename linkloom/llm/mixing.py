"""Mixing sources to target weights by temperature.

The weights are the sources' token shares to a power, normalised. The power is bisected so that
the weights have a target entropy, or no source is repeated more often than allowed. The
weights are realised as block permutations: a source's documents are dealt into blocks, the
blocks and the documents in each are put in a seeded order, and the source's budget takes
whole rounds of that order and then its first part."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, looked_up, unused

#: Sources whose weights are sent to every task; of more, only those of frequent ones are.
SENT_SOURCES = 100_000
#: Parts that one step of the bisection cuts the range of powers into, and steps.
CUTS, STEPS = 16, 12


def _moments(shares: DataFrame, powers: list[float]) -> list[tuple[float, float]]:
    """For each power, the sums of p ** power and of p ** power * ln(p) over all shares p."""
    raised = [F.pow(F.col("p"), F.lit(x)) for x in powers]
    row = shares.agg(*[F.sum(r) for r in raised], *[F.sum(r * F.ln("p")) for r in raised]).first()
    return list(zip(row[: len(powers)], row[len(powers) :], strict=True))


def _bisected(holds: Callable[[list[float]], list[bool]]) -> float:
    """The smallest power from 0 to 1 that `holds`, which all larger ones do as well. Each step
    cuts the range in CUTS parts and asks for all of them at once."""
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        tried = [low + (high - low) * i / CUTS for i in range(1, CUTS)]
        first = [*holds(tried), True].index(True)
        low, high = [low, *tried][first], [*tried, high][first]
    return high


def source_weights(totals: DataFrame, max_repetition: float | None = 4.0, target_entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """totals (source, tokens, documents) with power, weight, budget and rounds of each source.

    Either the entropy (in nats) of the weights is target_entropy, as near as a power from 0 to
    1 comes, or no source is taken more than max_repetition times. budget: tokens of the
    mix; None: the fewest with which no source loses a document. Sources without tokens have
    the weight 0 and are taken once. Only sums over the sources reach the driver; totals is
    read several times, so it should be a table."""
    some = totals.where("tokens > 0").agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    all_, least, most = (float(x or 1) for x in some)
    shares = totals.where("tokens > 0").select((F.col("tokens") / F.lit(all_)).alias("p"))
    small, top, power = least / all_, most / all_, 1.0
    if some[0] is None:
        norm = 1.0
    else:
        if target_entropy is not None:
            # The entropy falls as the power grows.
            power = _bisected(lambda xs: [math.log(n) - x * m / n <= target_entropy for x, (n, m) in zip(xs, _moments(shares, xs), strict=True)])
        elif max_repetition is not None and budget is None:
            # Rounds are p ** (power - 1), 1 for the largest source; the smallest has the most.
            power = _bisected(lambda xs: [(small / top) ** (x - 1) <= max_repetition for x in xs])
        elif max_repetition is not None:
            power = _bisected(lambda xs: [budget / all_ * small ** (x - 1) / n <= max_repetition for x, (n, _) in zip(xs, _moments(shares, xs), strict=True)])
        norm = _moments(shares, [power])[0][0]
    size = float(budget) if budget is not None else all_ * top / (top**power / norm)
    out = totals.withColumn("power", F.lit(power))
    out = out.withColumn("weight", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(all_), F.lit(power)) / F.lit(norm)).otherwise(0.0))
    out = out.withColumn("budget", F.round(F.col("weight") * F.lit(size)).cast("long"))
    if budget is None:  # rounding must not cost the largest source a document
        out = out.withColumn("budget", F.greatest("budget", "tokens"))
    out = out.withColumn("rounds", F.when(F.col("tokens") > 0, F.col("budget") / F.col("tokens")).otherwise(1.0))
    return out.select("source", "tokens", "documents", "power", "weight", "budget", "rounds")


NAMES = ("tokens", "weight", "copies", "block", "place")


def _counted(df: DataFrame, source: str, text: str, key: str, seed: int, own: list[str]) -> DataFrame:
    """df with its source, tokens and place in the seeded order, in columns named by `own`."""
    tokens = F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")
    # The order of a document: by its hash, and its place in the scan where copies tie.
    at = F.struct(F.xxhash64(F.lit(seed), key, F.xxhash64(text)).alias("h"), F.monotonically_increasing_id().alias("n"))
    return df.withColumns(dict(zip(own, (F.struct(F.col(source).alias("source")), tokens, at), strict=True)))


def _mixed(rows: DataFrame, light: DataFrame, own: list[str], names: tuple[str, ...], max_repetition, target_entropy, budget, block_documents: int, seed: int) -> DataFrame:
    """rows with the columns `names`; light: the table of rows' columns `own`."""
    source, tokens, at = own
    all_, documents, allowed, to, before = unused(rows, 5, *names)
    totals = checkpointed(light.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("tokens"), F.count(F.lit(1)).alias("documents")))
    weights = source_weights(totals, max_repetition, target_entropy, budget)
    weights = weights.select(F.col("source").alias(source), F.col("tokens").alias(all_), F.col("documents").alias(documents), F.col("weight").alias(names[1]), F.col("budget").alias(allowed), F.col("documents").alias(to))
    few = totals.count() <= SENT_SOURCES
    weights = weights if few else checkpointed(weights)

    def weighted(x: DataFrame) -> DataFrame:
        x = x.join(F.broadcast(weights.drop(to)), source) if few else looked_up(x, weights, source, to)
        blocks = F.ceil(F.col(documents) / block_documents)
        return x.withColumn(names[3], F.pmod(F.xxhash64(F.lit(seed + 1), at), blocks))

    inside = Window.partitionBy(source, names[3]).orderBy(at)
    out = weighted(rows).withColumn(names[4], F.row_number().over(inside) - 1).withColumn(to, F.sum(tokens).over(inside))
    sums = weighted(light).groupBy(source, names[3]).agg(F.sum(tokens).alias(before))
    # One row for each block; blocks are numbered at random, so their order is a permutation.
    earlier = Window.partitionBy(source).orderBy(names[3]).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(source, names[3], F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    out = out.join(sums, [source, names[3]])
    some = F.col(all_) > 0
    whole = F.when(some, F.floor(F.col(allowed) / F.when(some, F.col(all_)))).otherwise(1)
    rest = F.when(some, F.col(allowed) % F.when(some, F.col(all_))).otherwise(0)
    copies = whole + F.when(F.col(before) + F.col(to) <= rest, 1).otherwise(0)
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in own and c not in names]
    return out.select(*kept, F.col(tokens).alias(names[0]), names[1], copies.cast("int").alias(names[2]), names[3], names[4])


def mix(df: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id", max_repetition: float | None = 4.0, target_entropy: float | None = None, budget: int | None = None, block_documents: int = 2000, seed: int = 7, names: tuple[str, ...] = NAMES) -> DataFrame:
    """df's rows with tokens (words of the text), weight, copies, block and place.

    copies says how often the mix takes a document: the whole rounds of its source, and once
    more where the last, partial round reaches it. That round takes documents, in the order
    of (block, place), as long as it stays within the budget. A null source is a source of its
    own; a null or empty text has 0 tokens and goes with the rounds; repeated rows are rows of
    their own; an empty table gives no rows. The new columns are named by `names`, and columns
    of these names are replaced. df has to replay in order, as tables do. Rows stay rows: use
    `repeated` for the mix itself."""
    df = df.drop(*names)
    own = unused(df, 3, *names)
    rows = _counted(df, source, text, key, seed, own)
    return _mixed(rows, checkpointed(rows.select(*own)), own, names, max_repetition, target_entropy, budget, block_documents, seed)


def repeated(mixed: DataFrame, copies: str = "copies") -> DataFrame:
    """The rows of a mix, each as often as it is taken."""
    at = unused(mixed, 1)[0]
    return mixed.where(F.col(copies) > 0).withColumn(at, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(at)


def op7_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's doc_id, source, tokens, weight, copies, block, place."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    own = unused(docs, 3)
    rows = checkpointed(_counted(docs, "source", "text", "doc_id", 7, own).drop("text"))  # the one pass over the texts
    return _mixed(rows, rows.select(*own), own, NAMES, 4.0, None, None, 2000, 7)
