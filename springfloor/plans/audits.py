"""Quality audits of the loaded data, each a query over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config
from ..runtime import broadcast_if_small, table


def _facts(spark: SparkSession, d: str) -> DataFrame:
    apparatus = table(spark, d, "apparatus").select("apparatus_id", F.col("name").alias("apparatus"))
    return table(spark, d, "results_v2").join(broadcast_if_small(apparatus), "apparatus_id")


def audit_missing_all_around(spark: SparkSession, d: str) -> DataFrame:
    """Athletes of a meet with more than two events and no all-around row."""
    g = _facts(spark, d).groupBy("meet_db_id", "athlete_id").agg(F.count_if(F.col("apparatus") == config.ALL_AROUND).alias("aa"), F.count(F.lit(1)).alias("events"))
    return g.filter("aa = 0 and events > 2").select("meet_db_id", "athlete_id", "events")


def audit_ranked_zero(spark: SparkSession, d: str) -> DataFrame:
    """Ranked below twenty with a score of zero or none, per source and apparatus."""
    meets = table(spark, d, "meets").select("meet_db_id", "source")
    x = _facts(spark, d).filter("rank_numeric < 20 and coalesce(score_final, 0) = 0")
    return x.join(broadcast_if_small(meets), "meet_db_id").groupBy("source", "apparatus").agg(F.count(F.lit(1)).alias("n"))


def audit_high_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores above 9.8 that are no all-around."""
    return _facts(spark, d).filter((F.col("apparatus") != config.ALL_AROUND) & (F.col("score_final") > 9.8)).select("result_id", "apparatus", "score_final")


def audit_incomplete_levels(spark: SparkSession, d: str) -> DataFrame:
    """Athletes with two apparatus or more fewer than what is usual (the highest mode) in
    their meet and level."""
    n = _facts(spark, d).filter(F.col("level").isNotNull()).groupBy("meet_db_id", "level", "athlete_id").agg(F.countDistinct("apparatus").alias("k"))
    freq = n.groupBy("meet_db_id", "level", "k").agg(F.count(F.lit(1)).alias("c"))
    mode = freq.groupBy("meet_db_id", "level").agg(F.max_by("k", F.struct("c", "k")).alias("usual"))
    return n.join(mode, ["meet_db_id", "level"]).filter(F.col("k") < F.col("usual") - 1).select("meet_db_id", "level", "athlete_id", "k", "usual")


def audit_missing_apparatus(spark: SparkSession, d: str) -> DataFrame:
    """Which apparatus groups of athletes lack, per meet and level, where more than two do."""
    f = _facts(spark, d).filter((F.col("apparatus") != config.ALL_AROUND) & F.col("gender").isin("M", "F"))
    have = f.groupBy("meet_db_id", "level", "gender", "athlete_id").agg(F.collect_set("apparatus").alias("have"))
    full = lambda g: F.array(*[F.lit(n) for _, n in config.GOLD_ORDER[g] if n != config.ALL_AROUND])
    lack = F.array_join(F.array_sort(F.array_except(F.when(F.col("gender") == "M", full("M")).otherwise(full("F")), "have")), ",")
    return have.select("meet_db_id", "level", lack.alias("missing")).filter("missing != ''").groupBy("meet_db_id", "level", "missing").agg(F.count(F.lit(1)).alias("n")).filter("n > 2")


def audit_score_without_d(spark: SparkSession, d: str) -> DataFrame:
    """Scores without D, more than five in a meet and level."""
    f = _facts(spark, d).filter((F.col("apparatus") != config.ALL_AROUND) & F.col("score_final").isNotNull() & F.col("score_d").isNull())
    return f.groupBy("meet_db_id", "level").agg(F.count(F.lit(1)).alias("n")).filter("n > 5")


def audit_ghosts(spark: SparkSession, d: str) -> DataFrame:
    """All-around rows of athletes without any apparatus row in the meet."""
    f = _facts(spark, d)
    aa = f.filter(F.col("apparatus") == config.ALL_AROUND).select("result_id", "meet_db_id", "athlete_id")
    rest = f.filter(F.col("apparatus") != config.ALL_AROUND).select("meet_db_id", "athlete_id").distinct()
    return aa.join(rest, ["meet_db_id", "athlete_id"], "left_anti").select("result_id", "meet_db_id", "athlete_id")


def audit_small_meets(spark: SparkSession, d: str, least: int = 60) -> DataFrame:
    """Meets with fewer than ``least`` results, none included."""
    n = table(spark, d, "results_v2").groupBy("meet_db_id").agg(F.count(F.lit(1)).alias("n"))
    m = table(spark, d, "meets").join(n, "meet_db_id", "left").fillna(0, ["n"])
    return m.filter(F.col("n") < least).select("meet_db_id", F.concat_ws("_", "source", "source_meet_id").alias("meet_key"), "n")


def audit_blank_apparatus(spark: SparkSession, d: str) -> DataFrame:
    """Meets and levels of more than one row in which some apparatus has no score at all."""
    g = table(spark, d, "gold_results_wag")
    ps = [p for p, _ in config.GOLD_ORDER["F"] if p != "aa"]
    out = g.groupBy("meet_name", "level").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(F.trim(f"{p}_score"), F.lit("")) != "").alias(p) for p in ps])
    return out.filter("n > 1 and (" + " or ".join(f"{p} = 0" for p in ps) + ")")


def audit_unused_columns(spark: SparkSession, d: str) -> DataFrame:
    """Fact columns by whether and how often they are filled, from one aggregation."""
    r = table(spark, d, "results_v2")
    names = ["age", "province", "score_sv", "score_e", "bonus", "execution_bonus", "penalty", "age_group", "num", "state", "session", "group_name"]
    one = r.agg(*[F.count(c).alias(c) for c in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in names])).alias("x")).select("x.*")


def audit_text_scores(spark: SparkSession, d: str) -> DataFrame:
    """The fifty most frequent texts in place of a score."""
    g = table(spark, d, "results_v2").filter("score_text is not null").groupBy("score_text").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), "score_text").limit(50)


def audit_file_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Per source: files in the ledger, those with rows, and rows."""
    rows = table(spark, d, "results_v2").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    f = table(spark, d, "processed_files").join(rows, F.col("file_path") == F.col("source_file"), "left")
    return f.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.count("n").alias("with_rows"), F.sum(F.coalesce("n", F.lit(0))).alias("result_rows"))


def audit_within_person_clubs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of clubs that one person is registered with, the shorter name first."""
    clubs = table(spark, d, "clubs").select("club_id", "name")
    a = table(spark, d, "athletes").filter("club_id is not null").select("person_id", "club_id").distinct().join(broadcast_if_small(clubs), "club_id")
    b = a.select("person_id", F.col("club_id").alias("other_id"), F.col("name").alias("other"))
    first = (F.length("name") < F.length("other")) | (F.length("name") == F.length("other")) & (F.col("name") < F.col("other"))
    return a.join(b, "person_id").filter(first).groupBy(F.col("name").alias("club"), F.col("other").alias("other_club")).agg(F.countDistinct("person_id").alias("persons"))


def audit_missed_files(spark: SparkSession, d: str) -> DataFrame:
    """Files processed after a later-numbered file of their feed."""
    w = W.partitionBy("feed").orderBy("file_seq").rowsBetween(1, W.unboundedFollowing)
    f = table(spark, d, "processed_files").withColumn("next_min", F.min("last_processed").over(w))
    return f.filter("next_min < last_processed").select("feed", "file_seq")


QUERIES = {
    f.__name__: f
    for f in (
        audit_missing_all_around, audit_ranked_zero, audit_high_scores, audit_incomplete_levels, audit_missing_apparatus, audit_score_without_d, audit_ghosts, audit_small_meets,
        audit_blank_apparatus, audit_unused_columns, audit_text_scores, audit_file_coverage, audit_within_person_clubs, audit_missed_files,
    )
}

_FACTS = "(select r.*, a.name as apparatus from results_v2 r join apparatus a using (apparatus_id))"
_UNUSED = ["age", "province", "score_sv", "score_e", "bonus", "execution_bonus", "penalty", "age_group", "num", "state", "session", "group_name"]
SQL = {
    "audit_missing_all_around": f"select meet_db_id, athlete_id, count(*) as events from {_FACTS} group by 1, 2 having count(*) filter (apparatus = 'All Around') = 0 and count(*) > 2",
    "audit_ranked_zero": f"select m.source, apparatus, count(*) as n from {_FACTS} join meets m using (meet_db_id) where rank_numeric < 20 and coalesce(score_final, 0) = 0 group by 1, 2",
    "audit_high_scores": f"select result_id, apparatus, score_final from {_FACTS} where apparatus != 'All Around' and score_final > 9.8",
    "audit_incomplete_levels": f"""
  with n as (select meet_db_id, level, athlete_id, count(distinct apparatus) as k from {_FACTS} where level is not null group by all),
  f as (select meet_db_id, level, k, count(*) as c from n group by all),
  m as (select meet_db_id, level, k as usual from f qualify row_number() over (partition by meet_db_id, level order by c desc, k desc) = 1)
  select meet_db_id, level, athlete_id, k, usual from n join m using (meet_db_id, level) where k < usual - 1""",
    "audit_missing_apparatus": f"""
  with have as (select meet_db_id, level, gender, athlete_id, list(distinct apparatus) as have from {_FACTS} where apparatus != 'All Around' and gender in ('M', 'F') group by all),
  lack as (select meet_db_id, level, array_to_string(list_sort(list_filter(case when gender = 'M' then ['Floor','Pommel Horse','Rings','Vault','Parallel Bars','High Bar'] else ['Vault','Uneven Bars','Beam','Floor'] end, lambda x: not list_contains(have, x))), ',') as missing from have)
  select meet_db_id, level, missing, count(*) as n from lack where missing != '' group by all having count(*) > 2""",
    "audit_score_without_d": f"select meet_db_id, level, count(*) as n from {_FACTS} where apparatus != 'All Around' and score_final is not null and score_d is null group by 1, 2 having count(*) > 5",
    "audit_ghosts": f"select result_id, meet_db_id, athlete_id from {_FACTS} f where apparatus = 'All Around' and not exists (select 1 from {_FACTS} g where g.meet_db_id = f.meet_db_id and g.athlete_id = f.athlete_id and g.apparatus != 'All Around')",
    "audit_small_meets": "select m.meet_db_id, m.source || '_' || m.source_meet_id as meet_key, count(r.result_id) as n from meets m left join results_v2 r using (meet_db_id) group by 1, 2 having count(r.result_id) < 60",
    "audit_blank_apparatus": "select * from (select meet_name, level, count(*) as n, " + ", ".join(f"count(*) filter (coalesce(trim({p}_score), '') != '') as {p}" for p in ("vt", "ub", "bb", "fx")) + " from gold_results_wag group by 1, 2) where n > 1 and (vt = 0 or ub = 0 or bb = 0 or fx = 0)",
    "audit_unused_columns": " union all ".join(f"select '{c}' as column_name, count({c}) as filled from results_v2" for c in _UNUSED),
    "audit_text_scores": "select score_text, count(*) as n from results_v2 where score_text is not null group by 1 order by n desc, score_text limit 50",
    "audit_file_coverage": "select f.source, count(*) as files, count(n) as with_rows, sum(coalesce(n, 0))::bigint as result_rows from processed_files f left join (select source_file, count(*) as n from results_v2 group by 1) on source_file = file_path group by 1",
    "audit_within_person_clubs": """
  with a as (select distinct person_id, name from athletes join clubs using (club_id))
  select a.name as club, b.name as other_club, count(distinct a.person_id) as persons from a join a b using (person_id) where length(a.name) < length(b.name) or length(a.name) = length(b.name) and a.name < b.name group by 1, 2""",
    "audit_missed_files": "select feed, file_seq from (select *, min(last_processed) over (partition by feed order by file_seq rows between 1 following and unbounded following) as m from processed_files) where m < last_processed",
}
