"""Pairs of names that may be one, for people to decide on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, club_body, reversed_words, similarity


def turned(names: DataFrame) -> DataFrame:
    """(name_1, name_2, reason) of names (name) that are the same words in reverse, in any case."""
    n = names.select(clean_text(F.col("name")).alias("k"), "name").distinct()
    a, b = n.select(F.lower("k").alias("k"), F.col("name").alias("name_1")), n.select(F.lower(reversed_words(F.col("k"))).alias("k"), F.col("name").alias("name_2"))
    return a.join(b, "k").filter("name_1 < name_2").select("name_1", "name_2", F.lit("Reversal").alias("reason"))


def without_initial(names: DataFrame) -> DataFrame:
    """(alias, canonical) of names of three words with an initial in the middle and the name without it."""
    w = F.split(F.lower(clean_text(F.col("name"))), " ")
    n = names.select("name", w.alias("w")).distinct()
    short = n.groupBy(F.array_join("w", " ").alias("k")).agg(F.min("name").alias("canonical"))
    long = n.filter((F.size("w") == 3) & (F.length(F.replace(F.try_element_at("w", F.lit(2)), F.lit("."), F.lit(""))) == 1))
    return long.select(F.col("name").alias("alias"), F.concat_ws(" ", F.col("w")[0], F.col("w")[2]).alias("k")).join(short, "k").select("alias", "canonical")


def similar(names: DataFrame, high: float = 0.9, low: float = 0.8) -> DataFrame:
    """(name_1, name_2, ratio): pairs of names whose matching-blocks ratio is above ``high``, or
    above ``low`` where they share all words but one.

    Candidates share a word and the first or last letter of another one (of a name of one
    word: its first two or last two letters). Of each pair only the smaller key counts
    words: those in fewer names first, so that common given names meet by their
    neighbours, not among themselves. The length alone must allow the ratio.
    """
    n = names.select("name", F.lower("name").alias("l")).filter(F.trim("name") != "").distinct()
    n = n.withColumn("w", F.array_distinct(F.filter(F.split(clean_text(F.col("l")), " "), lambda x: x != "")))
    edge = lambda x: F.array(F.concat(F.lit("<"), F.substring(x, 1, 1)), F.concat(F.lit(">"), F.substring(x, -1, 1)))
    pairs = F.flatten(F.transform("w", lambda x: F.flatten(F.transform(F.filter("w", lambda y: y != x), lambda y: F.transform(edge(y), lambda e: F.concat_ws(" ", x, e))))))
    alone = F.when(F.size("w") == 1, F.array(F.concat(F.lit("<<"), F.substring("l", 1, 2)), F.concat(F.lit(">>"), F.substring("l", -2, 2)))).otherwise(F.array().cast("array<string>"))
    keys = n.select("name", "l", "w", F.explode(F.array_distinct(F.concat(pairs, alone))).alias("k"))
    a, b = (keys.select(F.col("name").alias(f"name_{i}"), F.col("l").alias(f"l{i}"), F.col("w").alias(f"w{i}"), "k") for i in (1, 2))
    fits = 2 * F.least(F.length("l1"), F.length("l2")) > low * (F.length("l1") + F.length("l2"))
    met = a.join(b, "k").filter((F.col("name_1") < F.col("name_2")) & fits).drop("k").dropDuplicates(["name_1", "name_2"])
    x = met.withColumn("ratio", similarity("l1", "l2"))
    common = F.size(F.array_intersect("w1", "w2"))
    shared = (common >= F.least(F.size("w1"), F.size("w2")) - 1) & (F.size("w1") > 1)
    return x.filter((F.col("ratio") > high) | (F.col("ratio") > low) & shared).select("name_1", "name_2", "ratio")


def contained(clubs: DataFrame, least: int = 3) -> DataFrame:
    """(alias, canonical): names (name) that contain the core of another one in any case; the
    shorter is canonical, of equals the one that comes first; an alias has the
    shortest canonical.

    A core stands in a name only if its rarest three characters do, so cores and names meet
    there, by an equi-join, and are then compared.
    """
    n = clubs.select("name").filter("name is not null").distinct().withColumn("l", F.lower("name"))
    three = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 2, F.lit(1))), lambda i: F.substr(c, i, F.lit(3))))
    grams = n.select("name", "l", F.explode(three(F.col("l"))).alias("g"))
    often = grams.groupBy("g").agg(F.count(F.lit(1)).alias("f"))
    cores = n.select(F.col("name").alias("short"), F.lower(club_body(F.col("name"))).alias("core")).filter(F.length("core") >= least)
    rare = cores.select("short", "core", F.explode(three(F.col("core"))).alias("g")).join(often, "g").groupBy("short", "core").agg(F.min_by("g", F.struct("f", "g")).alias("g"))
    order = (F.length("short") < F.length("name")) | (F.length("short") == F.length("name")) & (F.col("short") < F.col("name"))
    met = rare.join(grams, "g").filter(order & (F.lower("short") != F.col("l")) & F.col("l").contains(F.col("core")))
    return met.groupBy(F.col("name").alias("alias")).agg(F.min_by("short", F.struct(F.length("short").alias("n"), "short")).alias("canonical"))


def overlapping(rows: DataFrame, key: str, words: str, least: int) -> DataFrame:
    """(a, b, common): pairs of keys whose word sets have ``least`` words or more in common, a < b.

    Words are ordered by rarity. Two sets with that many in common share a word even when
    each leaves out its ``least`` - 1 most frequent ones, so these are no keys: what
    nearly all names have makes no pairs. Repeated keys are one row; null sets have no pairs.
    """
    r = rows.select(F.col(key).alias("id"), F.array_distinct(words).alias("ws")).filter(F.size("ws") >= least).dropDuplicates(["id"])
    each = r.select("id", F.explode("ws").alias("w"))
    often = each.groupBy("w").agg(F.count(F.lit(1)).alias("f"))
    ordered = each.join(often, "w").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("f", "w"))), lambda x: x.w).alias("ws"))
    keys = ordered.select("id", "ws", F.explode(F.slice("ws", F.lit(1), F.size("ws") - (least - 1))).alias("k"))
    a, b = (keys.select(F.col("id").alias(n), F.col("ws").alias(f"{n}_ws"), "k") for n in ("a", "b"))
    met = a.join(b, "k").filter("a < b").drop("k").dropDuplicates(["a", "b"])
    return met.select("a", "b", F.size(F.array_intersect("a_ws", "b_ws")).cast("long").alias("common")).filter(F.col("common") >= least)
