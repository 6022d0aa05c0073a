"""Keeping a store in order: what the reference does row by row, as rewrites of whole tables.

Each gives the new version of a table; ``sinks.swap_table`` puts it in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small, small_table


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` without those whose key is among ``gone``; null keys stay."""
    return rows.join(broadcast_if_small(gone.select(key).filter(F.col(key).isNotNull()).distinct()), key, "left_anti")


def matching(meets: DataFrame, key: str, ids: list | None = None, patterns: list[str] | None = None, name: str = "name", year: str = "comp_year", of_year: int | None = None) -> DataFrame:
    """(key): meets by key, or by a pattern of their name in any case (and a year)."""
    chosen = F.lit(False)
    if ids:
        chosen = chosen | F.col(key).isin(ids)
    for p in patterns or []:
        hit = F.col(name).ilike(p)
        chosen = chosen | (hit & (F.col(year) == of_year) if of_year is not None else hit)
    return meets.filter(F.coalesce(chosen, F.lit(False))).select(key).distinct()


def with_years(meets: DataFrame, manifest: DataFrame, key: str, year: str) -> DataFrame:
    """Meets with the year of the manifest (key, year) where it has one, else their own."""
    m = manifest.groupBy(key).agg(F.max("year").alias("__year"))
    return meets.join(broadcast_if_small(m), key, "left").withColumn(year, F.coalesce("__year", year)).drop("__year")


def gaps(gold: DataFrame, scores: list[str], by: list[str], more_than: int) -> DataFrame:
    """(by..., n, <score>...): groups of more than so many rows in which some score is never there."""
    there = [F.count_if(F.coalesce(F.trim(c), F.lit("")) != "").alias(c) for c in scores]
    out = gold.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *there)
    return out.filter((F.col("n") > more_than) & F.exists(F.array(*scores), lambda x: x == 0))


def reset(facts: DataFrame, ledger: DataFrame, meets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(facts, ledger) without what belongs to ``meets`` (meet_db_id, source_meet_id): the facts
    of these meets, and the files whose path names them. A path is cut at what can't be
    part of an id, so that paths and ids meet in an equi-join."""
    f = without(facts, meets, "meet_db_id")
    words = F.explode(F.array_distinct(F.split("file_path", "[^A-Za-z0-9]+"))).alias("__w")
    named = ledger.select("file_path", words).join(meets.select(F.col("source_meet_id").alias("__w")).distinct(), "__w").select("file_path")
    return f, without(ledger, named, "file_path")


def reopened(status: DataFrame, dates: DataFrame, since: Column) -> tuple[DataFrame, DataFrame]:
    """(status, backup): late data. Meets (source, meet_id) that are done and took place since a
    day (dates: source, meet_id, day) lose their entry, so that they are fetched and
    loaded again; the backup is the status as it was."""
    late = dates.filter(F.col("day") >= since).select("source", "meet_id").distinct()
    again = status.filter("status = 'DONE'").join(late, ["source", "meet_id"], "left_semi").select("source", "meet_id")
    return status.join(again, ["source", "meet_id"], "left_anti"), status


def replaced(facts: DataFrame, fresh_rows: DataFrame, key: str) -> DataFrame:
    """Facts in which all rows of the keys that came again are replaced by the new ones."""
    return without(facts, fresh_rows, key).unionByName(fresh_rows, allowMissingColumns=True)


def rebuilt_status(files: DataFrame, source: str = "source", path: str = "file_path", but: tuple[str, ...] = ()) -> DataFrame:
    """(source, meet_id, status): DONE for every meet that a final file names."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    meet = F.when(F.col(source) == "mso", F.when(name.endswith("_mso.csv"), F.substring_index(name, "_mso.csv", 1))).when(name.contains("_FINAL_"), F.when(F.col(source) == "livemeet", F.substring_index(name, "_", 1)).otherwise(F.substring_index(name, "_FINAL_", 1)))
    out = files.select(F.col(source).alias("source"), meet.alias("meet_id")).filter("meet_id is not null").distinct()
    for word in but:
        out = out.filter(~F.col("meet_id").contains(word))
    return out.withColumn("status", F.lit("DONE"))


def open_meets(manifest: DataFrame, status: DataFrame, closed: tuple[str, ...] = ("DONE",)) -> DataFrame:
    """The meets (source, meet_id, ...) of the manifest whose status isn't among ``closed``."""
    done = status.filter(F.col("status").isin(*closed)).select("source", "meet_id").distinct()
    return manifest.join(done, ["source", "meet_id"], "left_anti")


def seeded(table: DataFrame, seeds: list[tuple], key: list[str]) -> DataFrame:
    """A table with the rows it must start with; rows whose key is there already stay as they are."""
    rows = small_table(table.sparkSession, seeds, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema))
    return table.unionByName(rows.join(table.select(*key), key, "left_anti").select(*table.columns))


def widened(rows: DataFrame, bag: str, columns: dict[str, str], allowed: tuple[str, ...]) -> DataFrame:
    """``rows`` with the whitelisted columns that are new, filled from the JSON object ``bag``,
    from which they are taken; others stay in it."""
    new = {c: kind for c, kind in columns.items() if c in allowed and c not in rows.columns}
    old = F.from_json(bag, "map<string,string>")
    rest = F.map_filter(old, lambda k, v: ~k.isin(*new)) if new else old
    out = rows.withColumns({c: F.try_element_at(old, F.lit(c)).try_cast(kind) for c, kind in new.items()})
    return out.withColumn(bag, F.when(old.isNull(), F.col(bag)).when(F.size(rest) > 0, F.to_json(rest)))
