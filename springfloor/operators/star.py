"""Star joins, gold pivots and what is derived from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config
from ..functions.text import is_number, leading_int, normal_level
from ..runtime import broadcast_if_small


def star(results: DataFrame, athletes: DataFrame, persons: DataFrame, clubs: DataFrame, meets: DataFrame, apparatus: DataFrame) -> DataFrame:
    """Facts with their athlete, person, club (may be none), meet and apparatus names."""
    a = athletes.select("athlete_id", "person_id", "club_id")
    p = persons.select("person_id", F.col("full_name").alias("athlete_name"))
    c = clubs.select("club_id", F.col("name").alias("club"))
    m = meets.select("meet_db_id", F.col("name").alias("meet_name"), "comp_year", F.col("start_date_iso").alias("meet_date"), "source")
    x = apparatus.select("apparatus_id", F.col("name").alias("apparatus"))
    out = results
    for dim, key, how in ((a, "athlete_id", "inner"), (p, "person_id", "inner"), (c, "club_id", "left"), (m, "meet_db_id", "inner"), (x, "apparatus_id", "inner")):
        out = out.join(broadcast_if_small(dim), key, how)
    return out


def text_of(x: Column) -> Column:
    """A score as text, at most three decimals."""
    return F.round(x, 3).cast("string")


def gold(facts: DataFrame, gender: str) -> DataFrame:
    """One wide row per person, meet and session that has any score.

    One conditional aggregation with map-side combine: for each apparatus the highest
    score and D, else their texts, and the best rank, else its text.
    """
    named = F.when(F.coalesce(F.trim("session"), F.lit("")) != "", F.concat("meet_name", F.lit(" ("), "session", F.lit(")"))).otherwise(F.col("meet_name"))
    aggs = [F.min(x).alias(x) for x in ("athlete_name", "comp_year", "meet_date", "club")] + [F.min(named).alias("meet_name"), F.min("level").alias("level"), F.max("age").cast("string").alias("age")]
    for p, name in config.GOLD_ORDER[gender]:
        on = lambda c, name=name: F.when(F.col("apparatus") == name, c)
        pick = lambda number, text: F.nullif(F.coalesce(number, text), F.lit(""))
        aggs += [
            pick(text_of(F.max(on(F.col("score_final")))), F.max(on(F.col("score_text")))).alias(f"{p}_score"),
            pick(text_of(F.max(on(F.col("score_d")))), F.max(on(F.col("__d_text")))).alias(f"{p}_d"),
            pick(F.min(on(F.col("rank_numeric"))).cast("string"), F.max(on(F.col("rank_text")))).alias(f"{p}_rank"),
        ]
    # the JSON is read once a row, not once an apparatus
    facts = facts.filter(F.col("gender") == gender).withColumn("__d_text", F.get_json_object("details_json", "$.score_d_text"))
    g = facts.groupBy("person_id", "meet_db_id", "session").agg(*aggs, F.max("score_final").alias("any_score"))
    first = ["athlete_name", "comp_year", "meet_date", "meet_name", "level", "age", "club"]
    return g.filter("any_score is not null").select("person_id", "meet_db_id", "session", *first, *[f"{p}_{x}" for p, _ in config.GOLD_ORDER[gender] for x in ("score", "d", "rank")])


def propagate_ranks(rows: DataFrame, ranks: list[str], athlete: str = "athlete_name", date: str = "meet_date", level: str = "level") -> DataFrame:
    """Blank ranks filled with the best of the same athlete, date and level, then, where
    the level is blank, of the same athlete and date. Null dates are left alone."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    best = lambda c, w: F.min(F.when(~blank(c), leading_int(F.col(c)))).over(w)
    fine, coarse = W.partitionBy(athlete, date, level), W.partitionBy(athlete, date)
    no_level = normal_level(F.col(level)) == ""
    out = {}
    for c in ranks:
        one = F.when(F.col(date).isNotNull() & ~no_level, best(c, fine))
        two = F.when(F.col(date).isNotNull() & no_level, best(c, coarse))
        out[c] = F.when(blank(c), F.coalesce(one, two).cast("string")).otherwise(F.col(c))
    return rows.withColumns(out)


def similar_rows_kept(rows: DataFrame, key: str, scores: list[str], total: str, athlete: str = "athlete_name", date: str = "meet_date", level: str = "level", meet: str = "meet_name") -> DataFrame:
    """``rows`` without those that repeat a kept row of the same athlete and date.

    Rows are taken with the most scores first, then with a level, then not combined,
    then by key. A row repeats a kept one if the totals agree within 0.005, or 80 %
    of the compared scores, or four and all but two. Text scores count if equal.
    Rows without an athlete or a date are of nobody and stay, and so do rows without
    any score. Exact copies are collapsed first, so that the fold runs over the
    different results of one athlete on one day, however often each is there.
    """
    num = lambda c: F.when(is_number(F.col(c)), F.trim(c).try_cast("double"))
    there = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    n = reduce(lambda p, q: p + q, [there(c).cast("int") for c in scores])
    item = F.struct(
        (-n).alias("n"), (normal_level(F.col(level)) == "").cast("int").alias("l"), F.col(meet).contains("(Combined)").cast("int").alias("c"), F.col(key).alias("k"),
        F.array(*[F.struct(there(c).alias("t"), num(c).alias("v"), F.col(c).alias("s")) for c in scores]).alias("s"), num(total).alias("a"),
    )
    same = lambda p, q: F.coalesce(F.abs(p.v - q.v) < 0.005, F.lit(False)) | (p.v.isNull() | q.v.isNull()) & F.coalesce(p.s == q.s, F.lit(False)) & (p.t | q.t)

    def repeats(kept: Column, x: Column) -> Column:
        pairs = F.zip_with(kept.s, x.s, lambda p, q: F.struct((p.t | q.t).alias("c"), same(p, q).alias("m")))
        compared, equal = F.size(F.filter(pairs, lambda p: p.c)), F.size(F.filter(pairs, lambda p: p.c & p.m))
        close = F.coalesce((kept.a != 0) & (x.a != 0) & (F.abs(kept.a - x.a) < 0.005), F.lit(False))
        return close | (compared > 0) & ((equal >= 0.8 * compared) | (equal >= 4) & (equal >= compared - 2))

    folds = (n > 0) & there(athlete) & there(date)
    # of copies equal in all that the fold looks at the first is the only candidate
    seen = rows.filter(folds).select(athlete, date, item.alias("x")).groupBy(athlete, date, *[F.col(f"x.{c}").alias(c) for c in "nlc"], F.to_json(F.struct("x.s", "x.a")).alias("j")).agg(F.min_by("x", "x.k").alias("x"))
    groups = seen.groupBy(athlete, date).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    start = F.slice("xs", 1, 0)
    kept = F.aggregate("xs", start, lambda acc, x: F.when(F.exists(acc, lambda y: repeats(y, x)), acc).otherwise(F.concat(acc, F.array(x))))
    keys = groups.select(F.explode(F.transform(kept, lambda x: x.k)).alias(key))
    return rows.filter(folds).join(keys, key, "left_semi").unionByName(rows.filter(~folds))


def fullest_kept(rows: DataFrame, keys: list[str], order: str, counted: list[str] | None = None) -> DataFrame:
    """Of rows equal in ``keys`` the one with the most filled columns (of ``counted``, else of
    all), then the least ``order``."""
    full = F.size(F.filter(F.array(*[F.col(c).cast("string") for c in counted or rows.columns]), lambda x: x.isNotNull()))
    w = W.partitionBy(*keys).orderBy(full.desc(), order)
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def first_kept(rows: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """Of rows equal in ``keys`` (nulls being equal) the first ``n`` by ``order``."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= n).drop("__n")


def peers(rows: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that share ``keys``, nulls being equal, with any chosen row."""
    k = chosen.select(*[F.col(c).alias("__" + c) for c in keys]).distinct()
    return rows.join(k, reduce(lambda p, q: p & q, [F.col(c).eqNullSafe(F.col("__" + c)) for c in keys]), "left_semi")


def multi_day_totals(rows: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Per athlete, date and level with two days and a combined total: the sum of the days,
    the total, and whether they agree."""
    score = F.coalesce(F.trim("aa_score").try_cast("decimal(9,3)"), F.lit(0).cast("decimal(9,3)"))
    like = lambda *xs: reduce(lambda p, q: p | q, [F.col("meet_name").ilike(f"%{x}%") for x in xs])
    zero = F.lit(0).cast("decimal(9,3)")
    best = lambda c: F.max(F.when(c, score).otherwise(zero))
    g = rows.groupBy("athlete_name", "meet_date", "level").agg(
        best(like("Day 1", "Jour 1", " D1")).alias("d1"), best(like("Day 2", "Jour 2", " D2")).alias("d2"), best(~like("Day", "Jour", " D1", " D2")).alias("combined")
    )
    g = g.filter("d1 > 0 and d2 > 0 and combined > 0")
    ok = F.abs(F.col("d1") + F.col("d2") - F.col("combined")) <= tolerance
    return g.select("athlete_name", "meet_date", "level", *[F.col(c).cast("double").alias(c) for c in ("d1", "d2", "combined")], ok.alias("agrees"))
