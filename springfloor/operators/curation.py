"""Curating aliases: what people decided about candidates, and maps turned round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def alias_groups(aliases: DataFrame) -> DataFrame:
    """(canonical, aliases): a map alias to canonical turned round, aliases sorted and distinct."""
    return aliases.filter("alias is not null and canonical is not null").groupBy("canonical").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))


def decided(candidates: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(aliases, discarded, open) of candidates (name_1, name_2, reason, choice).

    Choice 1 or 2 names the canonical one, the other becoming its alias; 0 discards;
    anything else stays open.
    """
    chosen = candidates.filter(F.col("choice").isin(1, 2))
    first = F.col("choice") == 1
    aliases = chosen.select(F.when(first, F.col("name_2")).otherwise(F.col("name_1")).alias("alias"), F.when(first, F.col("name_1")).otherwise(F.col("name_2")).alias("canonical"))
    return aliases, candidates.filter("choice = 0"), candidates.filter("choice is null or choice not in (0, 1, 2)")


def status_rows(status: DataFrame) -> DataFrame:
    """(source, meet_id, status) as written to CSV, in order of the key."""
    return status.select("source", "meet_id", "status").orderBy("source", "meet_id")


def page_of(kind: Column, meet_id: Column) -> Column:
    """The page of a meet on its site, below the site's address."""
    return (
        F.when(kind == "kscore", F.concat(F.lit("results/"), F.replace(meet_id, F.lit("kscore_"), F.lit("")))).when(kind == "livemeet", F.concat(F.lit("MeetResults?Id="), meet_id))
        .when(kind == "mso", F.concat(F.lit("Results/"), meet_id)).when(kind == "ksis", F.concat(F.lit("resultx.php?id_prop="), meet_id)).otherwise("Unknown URL")
    )


def kind_of(meet_id: Column) -> Column:
    """The site an id looks like."""
    return F.when(F.length(meet_id) == 32, "livemeet").when(meet_id.startswith("kscore_"), "kscore").otherwise("Unknown")


def failure_report(failures: DataFrame, manifest: DataFrame, most: int = 50) -> DataFrame:
    """(meet_id, fails, kind, name, page) of the ``most`` meets (meet_id) that fail most often;
    what the manifests (meet_id, name, kind) don't know is told from the id."""
    n = failures.groupBy("meet_id").agg(F.count(F.lit(1)).alias("fails"))
    known = manifest.groupBy("meet_id").agg(F.min("kind").alias("kind"), F.min("name").alias("name"))
    top = n.orderBy(F.desc("fails"), "meet_id").limit(most).join(known, "meet_id", "left")
    kind = F.coalesce("kind", kind_of(F.col("meet_id")))
    return top.select("meet_id", "fails", kind.alias("kind"), F.replace(F.coalesce("name", F.lit("Unknown Meet")), F.lit("|"), F.lit("-")).alias("name"), page_of(kind, F.col("meet_id")).alias("page"))


def by_name(rows: DataFrame, name: str, ids: DataFrame) -> DataFrame:
    """``rows`` with the meet_id of their name in ids (name, meet_id): by the name as it is, else
    in small letters; rows without one are left out. Of ids of one name the least counts."""
    exact = ids.groupBy(F.col("name").alias("__n")).agg(F.min("meet_id").alias("__e"))
    low = ids.groupBy(F.lower("name").alias("__l")).agg(F.min("meet_id").alias("__f"))
    out = rows.join(exact, F.col(name) == F.col("__n"), "left").join(low, F.lower(name) == F.col("__l"), "left")
    return out.withColumn("meet_id", F.coalesce("__e", "__f")).filter("meet_id is not null").drop("__n", "__l", "__e", "__f")


def remediation(gaps: DataFrame, ids: DataFrame) -> DataFrame:
    """(meet_id, kind, reason, levels): meets with ghosts are fetched again in full, others only
    in the levels with gaps, each level once. gaps: (meet_name, level, ghost)."""
    g = by_name(gaps, "meet_name", ids)
    full = g.filter("ghost").select("meet_id").distinct()
    some = g.filter("not ghost").join(full, "meet_id", "left_anti").groupBy("meet_id").agg(F.array_sort(F.collect_set("level")).alias("levels"))
    whole = full.select("meet_id", F.lit("full").alias("kind"), F.lit("Ghost Entries").alias("reason"), F.lit(None).cast("array<string>").alias("levels"))
    return whole.unionByName(some.select("meet_id", F.lit("targeted").alias("kind"), F.lit("Missing Apparatus").alias("reason"), "levels"))


def as_json(df: DataFrame) -> DataFrame:
    """(value): each row as one JSON object, nulls left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))
