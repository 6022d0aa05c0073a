"""Filling fixed-capacity containers with items.

Method: sum of squares. Each item goes where the sum, over gaps, of the squared
number of open bins with that gap becomes least. Items are dealt by hash to shards
of bounded size, each of which packs by itself; a shard leaves few bins part-empty,
so the loss does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import col, materialize
from . import tokens
from .splitting import Text, cut

#: A shard holds about this many bins, and at most about this many items.
BINS_PER_SHARD, ITEMS_PER_SHARD = 4096, 100_000


def sum_of_squares(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """(bin of each item, number of bins), in the order given; sizes 0 to capacity.

    Ties go to the smallest gap, then to the bin opened last; an item of size 0 goes
    to the first bin.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)  # open bins by gap; gap 0 isn't counted
    stacks: dict[int, list[int]] = {}
    bins, opened, where = 0, False, np.zeros(len(sizes), dtype=np.int64)
    for i, s in enumerate(sizes):
        if s == 0:
            bins = max(bins, 1)
            if bins == 1 and not opened:
                count[capacity], stacks[capacity] = 1, [0]
            opened = True
            continue
        if s > capacity:
            raise ValueError(f"an item of {s} exceeds the capacity of {capacity}")
        old = count[s:]
        change = 2 * (count[: capacity + 1 - s] - old + 1)
        change[0] = 1 - 2 * old[0]
        change = np.where(old > 0, change, np.iinfo(np.int64).max)
        k = int(change.argmin())
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        if change[k] <= fresh:
            gap = k + s
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, bins
            bins += 1
        where[i], opened = b, True
        if gap > s:
            count[gap - s] += 1
            stacks.setdefault(gap - s, []).append(b)
    return where, bins


def token_items(docs: DataFrame, key: str, text: str, capacities: list[int], vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """(key, capacity_tokens, piece_no, start_char, end_char, n_tokens): each text once per
    capacity, in pieces as full as possible if it alone exceeds it. Null texts give none."""
    narrow = docs.select(col(key).alias("id"), col(text).alias("text"))
    names = ["id", "capacity_tokens", "piece_no", "start_char", "end_char", "n_tokens"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokens.tokenizer(vocabulary)
        least = min(capacities, default=0)
        for batch in batches:
            rows: list[tuple] = []
            for i, s in zip(batch["id"], batch["text"]):
                if s is None:
                    continue
                ends = t.ends(s)
                n = len(ends)
                x = Text(s, t, ends) if n > least else None
                for c in capacities:
                    if n <= c:
                        rows.append((i, c, 0, 0, len(s), n))
                    else:
                        for k, (a, b, m) in enumerate(cut(x, c, 0, 1, natural=False)):
                            rows.append((i, c, k, int(x.chars[x.at[a]]), int(x.chars[x.at[b]]), m))
            yield pd.DataFrame(rows, columns=names)

    kind = narrow.schema["id"].dataType.simpleString()
    out = narrow.mapInPandas(run, f"id {kind}, capacity_tokens int, piece_no int, start_char bigint, end_char bigint, n_tokens int")
    return out.withColumnRenamed("id", key)


def pack(items: DataFrame, key: str) -> DataFrame:
    """``items`` (capacity_tokens, key, piece_no, n_tokens, ...) with a bin_id, unique per capacity.

    No bin holds more than its capacity. Items in a shard come in falling size, of
    equals in the order of a hash of their key, so the result depends on the items only. Empty items go to the
    first bin of their shard; repeated items are packed each.
    """
    items = materialize(items)
    need = items.groupBy("capacity_tokens").agg(F.sum(F.col("n_tokens").cast("long")).alias("size"), F.count(F.lit(1)).alias("n"))
    shards = need.select("capacity_tokens", F.greatest(F.ceil(F.col("size") / (F.col("capacity_tokens") * F.lit(BINS_PER_SHARD))), F.ceil(F.col("n") / F.lit(ITEMS_PER_SHARD)), F.lit(1)).cast("int").alias("shards"))
    order = F.xxhash64(F.col(key), "piece_no")
    dealt = items.join(F.broadcast(shards), "capacity_tokens")  # a row per capacity
    dealt = dealt.withColumn("__order", order).withColumn("__shard", F.pmod(F.xxhash64(F.lit(7), F.col(key), "piece_no"), F.col("shards")).cast("int")).drop("shards")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "__order", key, "piece_no"], ascending=[False, True, True, True], kind="stable")
        where, _ = sum_of_squares(group["n_tokens"].tolist(), int(group["capacity_tokens"].iat[0]))
        return group.assign(bin_id=(group["__shard"].to_numpy().astype(np.int64) << 32) + where).drop(columns=["__order", "__shard"])

    schema = items.withColumn("bin_id", F.lit(0).cast("long")).schema
    return dealt.groupBy("capacity_tokens", "__shard").applyInPandas(run, schema)


def fill_report(packed: DataFrame) -> DataFrame:
    """(capacity_tokens, bins, items, tokens, fill): how well the bins are filled."""
    b = packed.groupBy("capacity_tokens", "bin_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("k"))
    out = b.groupBy("capacity_tokens").agg(F.count(F.lit(1)).alias("bins"), F.sum("k").alias("items"), F.sum("t").alias("tokens"))
    return out.withColumn("fill", F.col("tokens") / (F.col("bins") * F.col("capacity_tokens")))
