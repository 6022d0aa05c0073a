"""Mixing sources to target weights.

Method: systematic sampling. All documents of a source have the same expected
number of copies; a prefix sum of these runs over the source, one random offset is
added, and a document is emitted once per integer boundary that its stretch crosses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import col, materialize

#: Rows of a source are numbered in buckets of about this many rows.
BUCKET_ROWS = 50_000


def rates(sized: DataFrame, source: str, targets: DataFrame, budget: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, source_tokens, source_docs, rate, budget).

    The budget is the largest total at which every source reaches its share without
    more than max_repeats copies of a document, or the one given; a source that
    can't reach its share of a given budget is used max_repeats times throughout.
    Targets without documents get a rate of 0 and don't bound the budget.
    """
    have = sized.groupBy(col(source).alias("source")).agg(F.sum(F.col("n_tokens").cast("long")).alias("source_tokens"), F.count(F.lit(1)).alias("source_docs"))
    t = targets.select("source", "target_share", "max_repeats").filter("source is not null and target_share > 0 and max_repeats > 0").join(have, "source", "left").fillna(0, ["source_tokens", "source_docs"])
    reach = F.when(F.col("source_tokens") > 0, F.col("max_repeats") * F.col("source_tokens") / F.col("target_share"))
    total = F.lit(float(budget)) if budget is not None else F.min(reach).over(W.partitionBy(F.lit(0)))  # a row per target
    t = t.withColumn("budget", total)
    rate = F.least(F.col("target_share") * F.col("budget") / F.col("source_tokens"), F.col("max_repeats").cast("double"))
    return t.withColumn("rate", F.when(F.col("source_tokens") > 0, rate).otherwise(0.0))


def mix(sized: DataFrame, key: str, source: str, rated: DataFrame, seed: int = 42) -> DataFrame:
    """(key, source, n_tokens, copies) of the chosen documents, copies >= 1.

    A source's rows are dealt by hash to buckets, ordered by size within each, so
    that every stretch of the prefix sum holds documents of all sizes; the sums of
    the buckets before are one small aggregate, and no window spans a whole source.
    A rate up to max_repeats gives no document more than max_repeats copies.
    Documents without source, or of a source without target, or without text are
    not used; repeated rows count each.
    """
    r = rated.select(F.col("source").alias("__s"), "rate", "source_docs", "max_repeats").filter("rate > 0")
    rows = sized.select(col(key).alias(key), col(source).alias("source"), "n_tokens").filter("n_tokens is not null").join(F.broadcast(r), F.col("source") == F.col("__s"))  # a row per target
    buckets = F.greatest(F.ceil(F.col("source_docs") / F.lit(BUCKET_ROWS)), F.lit(1))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col(key)), buckets))
    sums = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sums.select("source", "bucket", (F.sum("n").over(W.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("before"))
    place = F.row_number().over(W.partitionBy("source", "bucket").orderBy("n_tokens", F.xxhash64(F.lit(seed), F.col(key)), key))
    rows = rows.withColumn("place", place).join(before, ["source", "bucket"])
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1_000_003)) / 1_000_003.0
    # in exact decimals, so that neighbouring documents agree on their common end
    step = F.col("rate").cast("decimal(20,12)")
    end = lambda i: F.floor((i.cast("decimal(18,0)") * step + offset.cast("decimal(20,12)")).cast("decimal(38,12)"))
    i = F.col("before") + F.col("place")
    copies = (end(i) - end(i - 1)).cast("int")
    return rows.select(key, "source", "n_tokens", F.least(copies, "max_repeats").alias("copies")).filter("copies > 0")


def share_report(mixed: DataFrame, rated: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, docs, copies, most_repeats, max_repeats)."""
    used = mixed.groupBy("source").agg(F.sum(F.col("n_tokens").cast("long") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("docs"), F.sum("copies").alias("copies"), F.max("copies").alias("most_repeats"))
    out = rated.select("source", "target_share", "max_repeats").join(used, "source", "left").fillna(0, ["tokens", "docs", "copies", "most_repeats"])
    return out.withColumn("actual_share", F.col("tokens") / F.sum("tokens").over(W.partitionBy(F.lit(0))))


def sized_once(sized: DataFrame) -> DataFrame:
    """The sizes written once: rates, bucket sums and rows all read them."""
    return materialize(sized)
