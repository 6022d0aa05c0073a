"""References to records that do not exist, or came into being later.

Method: keys are composite and may be partly null, so references are grouped by
null mask; each mask anti-joins the parents on its non-null columns under the
declared match semantics. Distinct keys are aggregated before any join (map-side
combine), so a key that holds a third of all rows costs one row in the joins; the
rows are then joined once with the keys at fault only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small, col, materialize

MATCHES = ("simple", "partial", "full")


@dataclass(frozen=True)
class Reference:
    """A declared foreign key.

    match, as in SQL: ``simple``: a null in any column satisfies it; ``partial``:
    the non-null columns must match some parent; ``full``: all null satisfies it,
    some null never does. With ``parent_time`` and the child's time, a parent
    whose earliest time is after the child's makes the reference ``late``.
    """

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]
    match: str = "simple"
    parent_time: str | None = None


def _masked(key: Column) -> tuple[Column, Column]:
    """(null mask, non-null values) of a key, an array of texts."""
    return F.array_join(F.transform(key, lambda x: F.when(x.isNull(), "0").otherwise("1")), ""), F.filter(key, lambda x: x.isNotNull())


def _parents(refs: list[Reference], late: bool) -> DataFrame:
    """(ref, mask, filled, born): the distinct parent keys of each reference, for each mask of
    columns by which they can be asked for, with the earliest time."""
    out = []
    for i, ref in enumerate(refs):
        n = len(ref.columns)
        born = col(ref.parent_time).cast("timestamp") if late and ref.parent_time else F.lit(None).cast("timestamp")
        for mask in product("10", repeat=n):
            if "1" not in mask or ref.match != "partial" and "0" in mask:
                continue
            values = F.array(*[col(c).cast("string") for c, m in zip(ref.parent_columns, mask) if m == "1"])
            out.append(ref.parent.select(F.lit(i).alias("ref"), F.lit("".join(mask)).alias("mask"), values.alias("filled"), born.alias("born")))
    return reduce(DataFrame.unionByName, out).groupBy("ref", "mask", "filled").agg(F.min("born").alias("born"), F.lit(True).alias("there"))


def orphan_references(child: DataFrame, key: str, refs: list[Reference], time: str | None = None) -> DataFrame:
    """(key, ref_column, kind, ref_time): one row per row of ``child`` and faulty reference.

    kind is ``missing`` (no parent has the key) or ``late`` (the parent's time is
    after the child's). Null times are never late. Repeated child rows each count;
    repeated parents count once, by their earliest time. Empty tables: without
    parents every non-null reference is missing; without children nothing is.
    Extra columns are ignored. ref_time is the child's time (null without one).

    All references come from one generator over one scan. Their distinct keys are
    aggregated (map-side combine), met with the parents in one join, and what is at
    fault is written; the rows then meet that, a broadcast if its size allows.
    """
    for ref in refs:
        if ref.match not in MATCHES or len(ref.columns) != len(ref.parent_columns):
            raise ValueError(f"bad reference {ref}")
    used = F.lit(None).cast("timestamp") if time is None else col(time).cast("timestamp")

    def asked(ref: Reference, i: int) -> Column:
        kinds = {f.name: f.dataType for f in ref.parent.schema}
        values = F.array(*[col(c).try_cast(kinds[p]).cast("string") for c, p in zip(ref.columns, ref.parent_columns)])
        late = time is not None and ref.parent_time is not None
        return F.struct(F.lit(i).alias("ref"), values.alias("k"), (used if late else F.lit(None).cast("timestamp")).alias("used"))

    each = child.select(col(key).alias("__key"), (F.lit(None).cast("timestamp") if time is None else col(time)).alias("__time"), F.explode(F.array(*[asked(r, i) for i, r in enumerate(refs)])).alias("r")).select("__key", "__time", "r.*")
    each = each.filter(F.exists("k", lambda x: x.isNotNull()))  # nothing but nulls satisfies any match
    keys = each.groupBy("ref", "k").agg(F.min("used").alias("first_use"))
    mask, filled = _masked(F.col("k"))
    keys = keys.select("ref", "k", "first_use", mask.alias("mask"), filled.alias("filled"))
    some_null = F.col("mask").contains("0")
    of = lambda match: F.col("ref").isin([i for i, r in enumerate(refs) if r.match == match])
    keys = keys.filter(~(of("simple") & some_null))
    joined = keys.join(_parents(refs, time is not None), ["ref", "mask", "filled"], "left")
    bad = joined.filter(F.col("there").isNull() | (of("full") & some_null) | (F.col("born") > F.col("first_use")))
    missing = F.col("there").isNull() | (of("full") & some_null)
    bad = materialize(bad.select("ref", "k", missing.alias("missing"), "born"))
    same = (F.col("e.ref") == F.col("b.ref")) & (F.col("e.k") == F.col("b.k")) if all(r.match == "simple" for r in refs) else (F.col("e.ref") == F.col("b.ref")) & F.col("e.k").eqNullSafe(F.col("b.k"))
    hit = each.alias("e").join(broadcast_if_small(bad).alias("b"), same).filter(F.col("missing") | (F.col("born") > F.col("used")))
    name = F.element_at(F.array(*[F.lit(r.name) for r in refs]), F.col("e.ref") + 1)
    return hit.select(F.col("__key").alias(key), name.alias("ref_column"), F.when(F.col("missing"), "missing").otherwise("late").alias("kind"), F.col("__time").alias("ref_time"))


def orphan_counts(orphans: DataFrame, parents: dict[str, str]) -> DataFrame:
    """(parent_table, month, kind, n): counts per table and month (``yyyy-MM``, null
    without a time) of what orphan_references gave; ``parents`` maps ref to table."""
    name = F.coalesce(*[F.when(F.col("ref_column") == k, v) for k, v in parents.items()])
    return orphans.groupBy(name.alias("parent_table"), F.date_format("ref_time", "yyyy-MM").alias("month"), "kind").agg(F.count(F.lit(1)).alias("n"))
