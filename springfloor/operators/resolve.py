"""Resolving people, clubs and meets to one row each, and healing their data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import year_of
from ..runtime import broadcast_if_small, materialize
from .order import numbered


def through_aliases(rows: DataFrame, column: str, aliases: DataFrame, any_case: bool = False) -> DataFrame:
    """``column`` replaced by its canonical value where aliases (alias, canonical, pos) know
    it, the first by pos winning; else, if ``any_case``, by one equal but for case and blanks."""
    exact = aliases.groupBy("alias").agg(F.min_by("canonical", "pos").alias("__c1"))
    out = rows.join(broadcast_if_small(exact), F.col(column) == F.col("alias"), "left").drop("alias")
    found = F.col("__c1")
    if any_case:
        key = lambda x: F.lower(F.regexp_replace(x, r"\s+", ""))
        loose = aliases.groupBy(key(F.col("alias")).alias("__k")).agg(F.min_by("canonical", "pos").alias("__c2"))
        out = out.join(broadcast_if_small(loose), key(F.col(column)) == F.col("__k"), "left").drop("__k")
        found = F.coalesce("__c1", "__c2")
    return out.withColumn(column, F.coalesce(found, F.trim(F.col(column)))).drop("__c1", "__c2")


def unified(meets: DataFrame, key: str, name: str, year: str) -> DataFrame:
    """(key, canonical): each meet with the least key of those of the same name (but for case
    and blanks) and year; a missing year is read from the name."""
    y = F.coalesce(F.col(year), year_of(F.col(name)))
    unnamed = F.col(name).isNull() | F.lower(name).contains("unnamed:")
    k = F.when(unnamed, F.concat(F.lit("#"), F.col(key).cast("string"))).otherwise(F.lower(F.trim(name)))
    g = meets.select(key, k.alias("__n"), y.alias("__y"))
    first = g.groupBy("__n", "__y").agg(F.min(key).alias("canonical"))
    return g.join(first, (g["__n"] == first["__n"]) & g["__y"].eqNullSafe(first["__y"])).select(key, "canonical")


def repointed(facts: DataFrame, column: str, mapping: DataFrame, key: str) -> DataFrame:
    """Facts whose ``column`` follows a mapping (key, canonical); unknown values stay."""
    m = mapping.filter(F.col(key) != F.col("canonical")).select(F.col(key).alias("__k"), F.col("canonical").alias("__c"))
    return facts.join(broadcast_if_small(m), F.col(column) == F.col("__k"), "left").withColumn(column, F.coalesce("__c", column)).drop("__k", "__c")


def healed(rows: DataFrame, key: str, source: DataFrame, source_key: str, columns: dict[str, str], prefix: str) -> DataFrame:
    """Null columns filled from ``source``: by the key itself, by it with the prefix, else by
    a source key that it starts with (the longest), each by an equi-join.

    The prefix match joins on the lengths at which source keys end, a small table, so
    that no pair of unrelated rows is compared.
    """
    s = source.groupBy(F.col(source_key).alias("__k")).agg(*[F.min(b).alias("__" + a) for a, b in columns.items()])
    lengths = s.select(F.length("__k").alias("__l")).distinct()
    tries = rows.select(key, F.explode(F.array(F.struct(F.lit(0).alias("__o"), F.col(key).alias("__q")), F.struct(F.lit(1).alias("__o"), F.concat(F.lit(prefix), F.col(key)).alias("__q")))).alias("__t")).select(key, "__t.__o", "__t.__q")
    heads = rows.select(key).join(F.broadcast(lengths), F.length(key) > F.col("__l")).select(key, (F.lit(1 << 30) - F.col("__l")).alias("__o"), F.substring(F.col(key), F.lit(1), F.col("__l")).alias("__q"))
    hit = tries.unionByName(heads).distinct().join(s, F.col("__q") == F.col("__k"))
    best = hit.groupBy(key).agg(*[F.min_by("__" + a, "__o").alias("__" + a) for a in columns])
    out = rows.join(best, key, "left")
    return out.withColumns({a: F.coalesce(a, "__" + a) for a in columns}).drop(*["__" + a for a in columns])


def links(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct pairs, nulls being equal, with a key that depends on the pair only."""
    return rows.select(left, right).distinct().select(F.xxhash64(left, F.coalesce(F.col(right).cast("string"), F.lit("\x00"))).alias("link_id"), left, right)


def upgraded(rows: DataFrame, keys: list[str], order: list[Column], bag: str) -> DataFrame:
    """One row per key: each column's first non-null value by ``order``, JSON objects merged
    with earlier rows winning. Null order values come first; rows equal in order are
    taken by their values. Unreadable JSON gives nothing.

    Combining aggregates only: per key and column, and per key and JSON field, the
    first value; no group of rows is ever held together.
    """
    at = F.struct(*[x.alias(f"o{i}") for x, i in zip(order, range(len(order)))])
    rest = [c for c in rows.columns if c not in keys and c != bag]
    firsts = rows.withColumn("__at", at).groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(F.col("__at"), F.col(c)))).alias(c) for c in rest])
    pair = F.explode(F.map_entries(F.from_json(bag, "map<string,string>"))).alias("e")
    each = rows.select(*keys, at.alias("at"), pair).select(*keys, F.col("e.key").alias("f"), F.col("e.value").alias("v"), "at").filter("v is not null")
    fields = each.groupBy(*keys, "f").agg(F.min_by("v", F.struct("at", "v")).alias("v"))
    bags = fields.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("fs"))
    right = [F.col(k).alias(f"__{k}") for k in keys]
    same = reduce(lambda p, q: p & q, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    out = firsts.join(bags.select(*right, F.to_json(F.map_from_entries("fs")).alias(bag)), same, "left")
    return out.select(*keys, *rest, bag)


def overlaid(rows: DataFrame, manual: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without those of the manual keys, and the manual rows."""
    return rows.join(broadcast_if_small(manual.select(*keys).distinct()), keys, "left_anti").unionByName(manual, allowMissingColumns=True)


def resolved_names(names: DataFrame, known: DataFrame, aliases: DataFrame, typed: DataFrame | None = None) -> DataFrame:
    """(name, id, created): an id for each distinct name.

    A name goes through the typed aliases (alias, canonical, pos), then the alias table
    (alias, id), then the known ones (id, name); what is left is created, numbered from the
    highest id on in the order of the names. Nulls and blanks are no names.
    """
    asked = names.select(F.col("name")).filter(F.trim("name") != "").distinct().withColumn("__key", F.col("name"))
    if typed is not None:
        asked = through_aliases(asked, "__key", typed)
    a = aliases.groupBy(F.col("alias").alias("__key")).agg(F.min("id").alias("__a"))
    k = known.groupBy(F.col("name").alias("__key")).agg(F.min("id").alias("__k"))
    found = materialize(asked.join(broadcast_if_small(a), "__key", "left").join(broadcast_if_small(k), "__key", "left").select("name", "__key", F.coalesce("__a", "__k").alias("id")))
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    new = numbered(found.filter("id is null").select("__key").distinct(), ["__key"], "__n").select("__key", (F.col("__n") + 1 + top).alias("__new"))
    return found.join(broadcast_if_small(new), "__key", "left").select("name", F.coalesce("id", "__new").alias("id"), F.col("id").isNull().alias("created"))


def resolved_meets(known: DataFrame, incoming: DataFrame, iso: Column, land: Column) -> DataFrame:
    """(source, source_meet_id, meet_db_id, created, name, comp_year, start_date_iso, location, country):
    each incoming meet with the row it belongs to, healed.

    It is the one of its source and id, else the first of its name (but for case and blanks)
    and year, among the known ones and then among the new ones themselves. What the row
    lacks comes from the first incoming meet that is it; placeholders give way to names.
    A year is read from the date, then from the name. ``iso`` and ``land`` are the date
    and country of an incoming meet as expressions over its columns.
    """
    cols = ["name", "comp_year", "start_date_iso", "location", "country"]
    year = F.coalesce("comp_year", year_of(F.col("start_date_iso")), year_of(F.col("name")))
    new = incoming.withColumns({"comp_year": year, "start_date_iso": iso, "country": F.coalesce("country", land)}).select("source", "source_meet_id", *cols)
    new = new.groupBy("source", "source_meet_id").agg(F.min(F.struct(*cols)).alias("x")).select("source", "source_meet_id", "x.*")
    by_id = known.groupBy("source", "source_meet_id").agg(F.min("meet_db_id").alias("__own"))
    named = lambda df: df.filter(F.col("name").isNotNull() & ~F.col("name").contains("Unnamed:") & F.col("comp_year").isNotNull())
    label = F.lower(F.trim("name")).alias("__label")
    by_name = named(known).groupBy(label, "comp_year").agg(F.min("meet_db_id").alias("__same"))
    keyed = new.withColumn("__label", F.when(F.col("name").isNotNull() & ~F.col("name").contains("Unnamed:"), F.lower(F.trim("name"))))
    found = materialize(keyed.join(by_id, ["source", "source_meet_id"], "left").join(by_name, ["__label", "comp_year"], "left").withColumn("__id", F.coalesce("__own", "__same")))
    # new meets of one name and year are one
    groups = F.coalesce(F.concat("__label", F.lit("\x1f"), F.col("comp_year").cast("string")), F.concat(F.lit("\x1f"), "source", F.lit("\x1f"), "source_meet_id"))
    fresh_ones = found.filter("__id is null").withColumn("__group", groups)
    firsts = fresh_ones.groupBy("__group").agg(F.min(F.struct("source", "source_meet_id")).alias("__at"))
    top = known.agg(F.coalesce(F.max("meet_db_id"), F.lit(0))).first()[0]
    ids = numbered(firsts, ["__at"], "__n").select("__group", (F.col("__n") + 1 + top).alias("__new"))
    placed = materialize(found.withColumn("__group", F.when(F.col("__id").isNull(), groups)).join(ids, "__group", "left").withColumn("meet_db_id", F.coalesce("__id", "__new")))
    order = F.struct("source", "source_meet_id")
    offers = placed.groupBy("meet_db_id").agg(*[F.min_by(c, F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") & (F.lit(c != "location") | (F.col(c).cast("string") != "N/A")), order)).alias(f"__{c}") for c in cols])
    own = known.select("meet_db_id", *[F.col(c).alias(f"__k_{c}") for c in cols])
    bare = F.col("__k_name").isNull() | reduce(lambda p, q: p | q, [F.col("__k_name").contains(w) for w in ("Kscore", "Livemeet", "MSO", "Unnamed:", "Title not set")])
    out = placed.select("source", "source_meet_id", "meet_db_id", F.col("__id").isNull().alias("created")).join(offers, "meet_db_id").join(own, "meet_db_id", "left")
    better = F.when(~F.col("__name").contains("Unnamed:"), F.col("__name"))
    healed_cols = [F.when(F.coalesce(bare, F.lit(True)), F.coalesce(better, "__k_name")).otherwise(F.col("__k_name")).alias("name"), *[F.coalesce(F.nullif(F.col(f"__k_{c}"), F.lit("")) if c != "comp_year" else F.col("__k_comp_year"), f"__{c}").alias(c) for c in cols[1:]]]
    return out.select("source", "source_meet_id", "meet_db_id", "created", *healed_cols)


def merged_links(links: DataFrame, mapping: DataFrame, one: str, other: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(links, moved): links (key, one, other) whose ``one`` follows mapping (one, canonical).

    Where the canonical one has a link to the same ``other`` (null being one), the alias's
    link goes and ``moved`` (key, target) tells where its facts belong; else it is
    repointed. The canonical one's own link is kept first, then the least key.
    """
    m = mapping.filter(F.col(one) != F.col("canonical")).select(F.col(one).alias("__k"), F.col("canonical").alias("__c"))
    at = links.join(broadcast_if_small(m), F.col(one) == F.col("__k"), "left").select(key, F.coalesce("__c", one).alias(one), other, F.col("__c").isNotNull().cast("int").alias("__alias"))
    target = at.groupBy(one, other).agg(F.min_by(key, F.struct("__alias", key)).alias("target"))
    same = (F.col(f"a.{one}").eqNullSafe(F.col(f"t.{one}"))) & F.col(f"a.{other}").eqNullSafe(F.col(f"t.{other}"))
    # only links of aliases go; repeated links of others stay as they were
    both = at.alias("a").join(target.alias("t"), same).select(F.col(f"a.{key}").alias(key), F.col(f"a.{one}").alias(one), F.col(f"a.{other}").alias(other), "__alias", "target")
    goes = (F.col("__alias") == 1) & (F.col(key) != F.col("target"))
    return both.filter(~goes).select(key, one, other), both.filter(goes).select(key, "target")
