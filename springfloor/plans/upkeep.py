"""Queries of resolution, maintenance, curation, sinks and streams, each with its SQL twin."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import dates, text
from ..operators import candidates, curation, maintenance, order, reshape, resolve, sinks, star
from ..runtime import broadcast_if_small, materialize, scratch, small_table, table
from ..streaming import intake

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


_VALUES = lambda m: "(values " + ", ".join(f"('{a}', '{c}', {i})" for i, (a, c) in enumerate(m.items())) + ") t(alias, canonical, pos)"


def _aliases(spark: SparkSession, m: dict[str, str]) -> DataFrame:
    return small_table(spark, [(a, c, i) for i, (a, c) in enumerate(m.items())], "alias string, canonical string, pos int")


# --- resolution -------------------------------------------------------------------------------------
_TURN = "array_to_string(list_reverse(string_split(full_name, ' ')), ' ')"


@query(f"""with asked as (select distinct athlete_name as name from gold_results_wag where trim(coalesce(athlete_name, '')) != ''), a as (select {_TURN} as name, min(person_id) as id from persons group by 1), p as (select full_name as name, min(person_id) as id from persons where person_id % 3 != 0 group by 1),
  f as (select asked.name, coalesce(a.id, p.id) as id from asked left join a on a.name = asked.name left join p on p.name = asked.name)
  select name, coalesce(id, (select max(person_id) from persons where person_id % 3 != 0) + row_number() over (partition by id is null order by name)) as id, id is null as created from f""")
def resolved_persons(spark: SparkSession, d: str) -> DataFrame:
    """Athletes' names through an alias table, known people, and new ones; a third of the people
    is held back so that some are new."""
    p = table(spark, d, "persons").select(F.col("person_id").alias("id"), F.col("full_name").alias("name"))
    alias = p.select(text.reversed_words(F.col("name")).alias("alias"), "id")
    return resolve.resolved_names(table(spark, d, "gold_results_wag").select(F.col("athlete_name").alias("name")), p.filter("id % 3 != 0"), alias)


@query(f"""with asked as (select distinct club as name from gold_results_wag where trim(coalesce(club, '')) != ''), k as (select asked.name, coalesce(t.canonical, asked.name) as key from asked left join {_VALUES({"The Gym": "Gym"})} on t.alias = asked.name), c as (select name, min(club_id) as id from clubs group by 1),
  f as (select k.name, c.id from k left join c on c.name = k.key), n as (select distinct key from k join f using (name) where id is null), m as (select key, row_number() over (order by key) as i from n)
  select f.name, coalesce(f.id, (select max(club_id) from clubs) + m.i) as id, f.id is null as created from f join k using (name) left join m using (key)""")
def resolved_clubs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "clubs").select(F.col("club_id").alias("id"), "name")
    none = spark.createDataFrame([], "alias string, id bigint")
    return resolve.resolved_names(table(spark, d, "gold_results_wag").select(F.col("club").alias("name")), c, none, _aliases(spark, {"The Gym": "Gym"}))


_YEAR = lambda c: f"try_cast(nullif(regexp_extract({c}, '(20[0-9]{{2}})', 1), '') as int)"


@query(f"""with k as (select * from meets where meet_db_id % 3 != 0), i as (select source, source_meet_id, any_value(name) as name, any_value(coalesce(comp_year, {_YEAR("start_date_iso")}, {_YEAR("name")})) as y, any_value(location) as location from meets group by 1, 2),
  own as (select source, source_meet_id, min(meet_db_id) as id from k group by 1, 2), same as (select lower(trim(name)) as l, comp_year as y, min(meet_db_id) as id from k where name is not null and comp_year is not null group by 1, 2),
  f as (select i.*, coalesce(own.id, same.id) as id, case when i.name is not null and i.y is not null then lower(trim(i.name)) || '|' || i.y else '|' || i.source || '|' || i.source_meet_id end as g from i left join own using (source, source_meet_id) left join same on same.l = lower(trim(i.name)) and same.y = i.y),
  n as (select g, row_number() over (order by min(source || '~' || source_meet_id)) as r from f where id is null group by g), o as (select f.*, coalesce(f.id, (select max(meet_db_id) from k) + n.r) as m from f left join n on n.g = f.g and f.id is null),
  h as (select m, arg_min(y, source || '~' || source_meet_id) filter (y is not null) as y, arg_min(location, source || '~' || source_meet_id) filter (trim(coalesce(location, '')) not in ('', 'N/A')) as location from o group by 1)
  select o.source, o.source_meet_id, o.m as meet_db_id, o.id is null as created, coalesce(k.comp_year, h.y) as comp_year, coalesce(nullif(k.location, ''), h.location) as location from o join h using (m) left join k on k.meet_db_id = o.m""")
def resolved_meets(spark: SparkSession, d: str) -> DataFrame:
    """All meets as they come in, against two thirds of them: matched by id, by name and year, or
    created, and healed."""
    m = table(spark, d, "meets")
    land = text.country(F.col("location"), F.col("source"), F.col("name"))
    return resolve.resolved_meets(m.filter("meet_db_id % 3 != 0"), m, dates.iso_date(F.col("start_date_iso")), land).select("source", "source_meet_id", "meet_db_id", "created", "comp_year", "location")


_MERGE = "(select person_id, min(person_id) over (partition by lower(trim(regexp_replace(full_name, '\\s+', ' ', 'g')))) as canonical from persons)"
_MOVED = f"""with m as (select * from {_MERGE} where person_id != canonical), a as (select athlete_id, coalesce(m.canonical, person_id) as person_id, club_id, (m.canonical is not null)::int as alias from athletes left join m using (person_id)),
  t as (select *, first_value(athlete_id) over (partition by person_id, club_id order by alias, athlete_id) as target from a)"""


def _merged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, d, "persons").select("person_id", F.lower(text.clean_text(F.col("full_name"))).alias("n"))
    mapping = materialize(p.join(p.groupBy("n").agg(F.min("person_id").alias("canonical")), "n").select("person_id", "canonical"))
    return resolve.merged_links(table(spark, d, "athletes").select("athlete_id", "person_id", "club_id"), mapping, "person_id", "club_id", "athlete_id")


@query(f"{_MOVED} select athlete_id, person_id, club_id from t where not (alias = 1 and athlete_id != target)")
def merged_athletes(spark: SparkSession, d: str) -> DataFrame:
    """Athletes after people of one name are merged: repointed, or gone where the canonical one
    is with the same club."""
    return _merged(spark, d)[0]


@query(f"{_MOVED} select coalesce(t.target, r.athlete_id) as athlete_id, count(*) as n from results_v2 r left join t on t.athlete_id = r.athlete_id and t.alias = 1 and t.athlete_id != t.target group by 1")
def merged_facts(spark: SparkSession, d: str) -> DataFrame:
    moved = _merged(spark, d)[1].select("athlete_id", F.col("target").alias("canonical"))
    return resolve.repointed(table(spark, d, "results_v2").select("athlete_id"), "athlete_id", moved, "athlete_id").groupBy("athlete_id").agg(F.count(F.lit(1)).alias("n"))


_LOW = "lower(regexp_replace({0}, '\\s+', '', 'g'))"


@query(f"""with s as (select alias, arg_min(canonical, pos) as c from {_VALUES(config.SITE_LEVELS)} group by 1), l as (select alias, arg_min(canonical, pos) as c from {_VALUES(config.LEVELS)} group by 1), q as (select {_LOW.format("alias")} as k, arg_min(canonical, pos) as c from {_VALUES(config.LEVELS)} group by 1),
  r as (select result_id, coalesce(s.c, trim(level)) as level from results_v2 join meets using (meet_db_id) left join s on s.alias = level where source = 'kscore')
  select coalesce(l.c, q.c, trim(r.level)) as level, count(*) as n from r left join l on l.alias = r.level left join q on q.k = {_LOW.format("r.level")} group by 1""")
def site_levels(spark: SparkSession, d: str) -> DataFrame:
    """Levels of one site: its own map first, then the general one."""
    m = table(spark, d, "meets").filter("source = 'kscore'").select("meet_db_id")
    r = table(spark, d, "results_v2").select("meet_db_id", "level").join(broadcast_if_small(m), "meet_db_id").select("level")
    once = resolve.through_aliases(r, "level", _aliases(spark, config.SITE_LEVELS))
    return resolve.through_aliases(once, "level", _aliases(spark, config.LEVELS), any_case=True).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


_SUFFIX = "case when meet_name like '%)' and regexp_matches(meet_name, '\\((?:[^()]|\\([^()]*\\))*\\)$') then trim(regexp_replace(meet_name, '\\((?:[^()]|\\([^()]*\\))*\\)$', '')) else meet_name end"
_SCORES = [f"{p}_score" for p, _ in config.GOLD_ORDER["F"]]


@query(f"""with a as (select full_name as alias, min(full_name) over (partition by lower(trim(regexp_replace(full_name, '\\s+', ' ', 'g')))) as canonical from persons), g as (select gold_id, coalesce(a.canonical, trim(athlete_name)) as athlete_name, meet_date, {_SUFFIX.replace("meet_name", "trim(meet_name)")} as meet_name, level, age, {" + ".join(f"({c} is not null)::int" for c in _SCORES)} as n from gold_results_wag left join a on a.alias = athlete_name)
  select gold_id, athlete_name, meet_name from g qualify row_number() over (partition by athlete_name, meet_date, meet_name, level, age order by n desc, gold_id) = 1""")
def modified_gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold rows under canonical names, meets without their session, of new duplicates the
    fullest kept: all three in one plan."""
    p = table(spark, d, "persons").select(F.col("full_name").alias("alias"), F.lower(text.clean_text(F.col("full_name"))).alias("k"))
    alias = p.join(p.groupBy("k").agg(F.min("alias").alias("canonical")), "k").select("alias", "canonical", F.lit(0).alias("pos"))
    g = resolve.through_aliases(table(spark, d, "gold_results_wag"), "athlete_name", alias).withColumn("meet_name", text.without_suffix(F.trim("meet_name")))
    return star.fullest_kept(g.select("gold_id", "athlete_name", "meet_date", "meet_name", "level", "age", *_SCORES), ["athlete_name", "meet_date", "meet_name", "level", "age"], "gold_id", _SCORES).select("gold_id", "athlete_name", "meet_name")


# --- candidates -------------------------------------------------------------------------------------
@query("with n as (select distinct full_name as name from persons union select array_to_string(list_reverse(string_split(trim(regexp_replace(full_name, '\\s+', ' ', 'g')), ' ')), ' ') from persons where person_id % 5 = 0) select a.name as name_1, b.name as name_2, 'Reversal' as reason from n a join n b on lower(trim(regexp_replace(a.name, '\\s+', ' ', 'g'))) = lower(array_to_string(list_reverse(string_split(trim(regexp_replace(b.name, '\\s+', ' ', 'g')), ' ')), ' ')) where a.name < b.name")
def reversed_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Names that are others in reverse; every fifth name is put in turned as well."""
    p = table(spark, d, "persons")
    n = p.select(F.col("full_name").alias("name")).unionByName(p.filter("person_id % 5 = 0").select(text.reversed_words(text.clean_text(F.col("full_name"))).alias("name")))
    return candidates.turned(n)


@query("""with n as (select distinct full_name as name, string_split(lower(trim(regexp_replace(full_name, '\\s+', ' ', 'g'))), ' ') as w from persons union select distinct full_name || '', string_split(lower(trim(regexp_replace(full_name, '\\s+', ' ', 'g'))), ' ') from persons), s as (select array_to_string(w, ' ') as k, min(name) as canonical from n group by 1)
  select n.name as alias, s.canonical from n join s on s.k = w[1] || ' ' || w[3] where len(w) = 3 and length(replace(w[2], '.', '')) = 1""")
def initial_pairs(spark: SparkSession, d: str) -> DataFrame:
    return candidates.without_initial(table(spark, d, "persons").select(F.col("full_name").alias("name")))


@query()
def similar_names(spark: SparkSession, d: str) -> DataFrame:
    """Candidate pairs by similarity. SQL has no matching-blocks ratio; tests compare by brute force."""
    return candidates.similar(table(spark, d, "clubs").select("name").unionByName(table(spark, d, "persons").select(F.col("full_name").alias("name"))))


_BODY = "trim(regexp_replace(regexp_replace(name, '(?i)\\b(" + "|".join(config.CLUB_BODY_WORDS) + ")\\b', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"""with c as (select distinct name, {_BODY} as core from clubs where name is not null) select b.name as alias, arg_min(a.name, struct_pack(n := length(a.name), s := a.name)) as canonical from c a join c b on contains(lower(b.name), lower(a.core)) and lower(a.name) != lower(b.name)
  where length(a.core) >= 3 and (length(a.name) < length(b.name) or length(a.name) = length(b.name) and a.name < b.name) group by 1""")
def contained_clubs(spark: SparkSession, d: str) -> DataFrame:
    return candidates.contained(table(spark, d, "clubs"))


@query("""with a as (select lower(trim(name)) as k from meets where name is not null group by 1 having count(*) >= 1), p as (select person_id from persons where lower(full_name) like '%gorelfell%'),
  c as (select distinct p.person_id, m.name as meet, c.name as club, m.comp_year from p join athletes using (person_id) join results_v2 using (athlete_id) join meets m using (meet_db_id) join clubs c using (club_id))
  select person_id, meet, club, comp_year from c qualify row_number() over (partition by person_id order by comp_year desc nulls last, meet, club) <= 5""")
def candidate_context(spark: SparkSession, d: str) -> DataFrame:
    """Up to five meets and clubs of each person whose name has a word, the latest first."""
    p = table(spark, d, "persons").filter(F.col("full_name").ilike("%gorelfell%")).select("person_id")
    c = p.join(table(spark, d, "athletes").select("athlete_id", "person_id", "club_id"), "person_id").join(table(spark, d, "results_v2").select("athlete_id", "meet_db_id"), "athlete_id")
    c = c.join(table(spark, d, "meets").select("meet_db_id", F.col("name").alias("meet"), "comp_year"), "meet_db_id").join(table(spark, d, "clubs").select("club_id", F.col("name").alias("club")), "club_id")
    return star.first_kept(c.select("person_id", "meet", "club", "comp_year").distinct(), ["person_id"], [F.desc_nulls_last("comp_year"), F.asc_nulls_first("meet"), F.asc("club")], 5)


# --- maintenance ------------------------------------------------------------------------------------
@query("select meet_db_id, count(*) as n from results_v2 where meet_db_id not in (select meet_db_id from meets where meet_db_id in (12, 13) or name ilike '%cup%' and comp_year = 2022) group by 1")
def purged_facts(spark: SparkSession, d: str) -> DataFrame:
    gone = maintenance.matching(table(spark, d, "meets"), "meet_db_id", ids=[12, 13]).union(maintenance.matching(table(spark, d, "meets"), "meet_db_id", patterns=["%cup%"], of_year=2022))
    return maintenance.without(table(spark, d, "results_v2").select("meet_db_id"), gone, "meet_db_id").filter("meet_db_id is not null").groupBy("meet_db_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"select meet_db_id, coalesce({_YEAR('start_date_iso')}, comp_year) as comp_year from meets")
def updated_years(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meets")
    return maintenance.with_years(m, m.select("source_meet_id", text.year_of(F.col("start_date_iso")).alias("year")), "source_meet_id", "comp_year").select("meet_db_id", "comp_year")


_GAP = "(select m.meet_db_id, m.source_meet_id from meets m join (select source, " + _SUFFIX.replace("meet_name", "trim(meet_name)") + " as n, count(*) as k, " + ", ".join(f"count(*) filter (coalesce(trim({c}), '') != '') as {c}" for c in _SCORES) + " from gold_results_wag group by 1, 2) g on g.source = m.source and g.n = m.name where k > 2 and (" + "vt_score = 0 or ub_score = 0 or bb_score = 0 or fx_score = 0))"


def _gapped(spark: SparkSession, d: str) -> DataFrame:
    """Meets of more than two gold rows in which an apparatus has no score at all."""
    g = table(spark, d, "gold_results_wag").withColumn("n0", text.without_suffix(F.trim("meet_name")))
    bad = maintenance.gaps(g, [f"{p}_score" for p, _ in config.GOLD_ORDER["F"] if p != "aa"], ["source", "n0"], 2)
    return table(spark, d, "meets").join(bad.select("source", F.col("n0").alias("name")), ["source", "name"]).select("meet_db_id", "source_meet_id")


@query(f"select 'facts' as kept, count(*) as n from results_v2 where meet_db_id is null or meet_db_id not in (select meet_db_id from {_GAP}) union all select 'files', count(*) from processed_files where not list_has_any(regexp_split_to_array(file_path, '[^A-Za-z0-9]+'), (select coalesce(list(source_meet_id), []) from {_GAP}))")
def reset_gaps(spark: SparkSession, d: str) -> DataFrame:
    f, ledger = maintenance.reset(table(spark, d, "results_v2").select("meet_db_id"), table(spark, d, "processed_files"), _gapped(spark, d))
    return f.agg(F.count(F.lit(1)).alias("n")).select(F.lit("facts").alias("kept"), "n").unionByName(ledger.agg(F.count(F.lit(1)).alias("n")).select(F.lit("files").alias("kept"), "n"))


_STATUS = "(select source, source_meet_id as meet_id, case when comp_year % 4 = 0 then 'RETRYING' else 'DONE' end as status from meets)"


def _status(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meets").select("source", F.col("source_meet_id").alias("meet_id"), F.when(F.col("comp_year") % 4 == 0, "RETRYING").otherwise("DONE").alias("status"))


@query(f"select s.source, s.meet_id, s.status from {_STATUS} s join meets m on m.source = s.source and m.source_meet_id = s.meet_id where not (status = 'DONE' and coalesce(try_cast(start_date_iso as date), make_date(comp_year, 1, 2)) >= date '2022-06-01' and (try_cast(start_date_iso as date) is not null or comp_year is not null)) or start_date_iso is null and comp_year is null")
def reopened_meets(spark: SparkSession, d: str) -> DataFrame:
    """Late data: the status without the meets of a window, which will be fetched again."""
    m = table(spark, d, "meets")
    day = dates.manifest_date(F.when(F.col("start_date_iso").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("start_date_iso")), F.lit(None).cast("string"), F.col("comp_year").cast("string"))
    return maintenance.reopened(_status(spark, d), m.select("source", F.col("source_meet_id").alias("meet_id"), day.alias("day")), F.lit("2022-06-01").cast("date"))[0]


@query("select distinct source, case when source = 'livemeet' then split_part(regexp_extract(file_path, '([^/]*)$', 1), '_', 1) else split_part(regexp_extract(file_path, '([^/]*)$', 1), '_FINAL_', 1) end as meet_id, 'DONE' as status from processed_files where source != 'mso' and file_path like '%\\_FINAL\\_%' escape '\\' union select distinct source, split_part(regexp_extract(file_path, '([^/]*)$', 1), '_mso.csv', 1), 'DONE' from processed_files where source = 'mso' and file_path like '%\\_mso.csv' escape '\\'")
def rebuilt_status(spark: SparkSession, d: str) -> DataFrame:
    return maintenance.rebuilt_status(table(spark, d, "processed_files"))


@query(f"select m.source as kind, m.source_meet_id as meet_id, m.name, coalesce(m.comp_year::varchar, 'N/A') as year, row_number() over (order by m.source, m.comp_year desc nulls last, m.source_meet_id) - 1 as place from meets m join {_STATUS} s on s.source = m.source and s.meet_id = m.source_meet_id where s.status not in ('DONE', 'FAILED')")
def open_meets(spark: SparkSession, d: str) -> DataFrame:
    """Meets of the manifest that aren't done, listed in order."""
    m = table(spark, d, "meets").select("source", F.col("source_meet_id").alias("meet_id"), "name", "comp_year")
    left = maintenance.open_meets(m, _status(spark, d), ("DONE", "FAILED"))
    out = order.numbered(left, ["source", F.desc_nulls_last("comp_year"), "meet_id"], "place")
    return out.select(F.col("source").alias("kind"), "meet_id", "name", F.coalesce(F.col("comp_year").cast("string"), F.lit("N/A")).alias("year"), "place")


@query(f"select s.source, s.meet_id, count(r.result_id) as n from {_STATUS} s join meets m on m.source = s.source and m.source_meet_id = s.meet_id left join results_v2 r on r.meet_db_id = m.meet_db_id where s.status = 'DONE' group by 1, 2 having count(r.result_id) < 60")
def incomplete_meets(spark: SparkSession, d: str) -> DataFrame:
    """Done meets with few results, none included."""
    n = table(spark, d, "results_v2").groupBy("meet_db_id").agg(F.count(F.lit(1)).alias("n"))
    m = table(spark, d, "meets").select("meet_db_id", "source", F.col("source_meet_id").alias("meet_id")).join(n, "meet_db_id", "left")
    return m.join(_status(spark, d).filter("status = 'DONE'"), ["source", "meet_id"]).select("source", "meet_id", F.coalesce("n", F.lit(0)).alias("n")).filter("n < 60")


@query("select file_path, source from processed_files where file_path not in (select source_file from results_v2 where source_file is not null and level = 'Gold')")
def files_without_gold(spark: SparkSession, d: str) -> DataFrame:
    """Files of the ledger that gave no fact of a level."""
    f = table(spark, d, "processed_files").select("file_path", "source")
    return maintenance.without(f, table(spark, d, "results_v2").filter("level = 'Gold'").select(F.col("source_file").alias("file_path")), "file_path")


_SEEDS = [(i, n, g) for i, n, g in config.DISCIPLINES]


@query("select * from (values " + ", ".join(f"({i}, '{n}', '{g}')" for i, n, g in _SEEDS) + ") t(id, name, gender) where id not in (select distinct discipline_id from apparatus where discipline_id = 1) union all select distinct discipline_id, 'kept', 'kept' from apparatus where discipline_id = 1")
def seeded_rows(spark: SparkSession, d: str) -> DataFrame:
    """Disciplines a store starts with; one is there already."""
    there = table(spark, d, "apparatus").filter("discipline_id = 1").select(F.col("discipline_id").alias("id"), F.lit("kept").alias("name"), F.lit("kept").alias("gender")).distinct()
    return maintenance.seeded(there, _SEEDS, ["id"])


_STD = "(values " + ", ".join(f"('{c}', '{s}', '{x}', {'null' if m is None else m}::double, {str(b).lower()})" for c, s, x, m, b in config.SCORING_STANDARDS) + ") t(country, system, level, maximum, has_d)"


@query(f"select r.level, s.country, s.system, s.maximum, count(*) as n from results_v2 r join {_STD.replace(') t(', ') s(')} on s.level = r.level where s.maximum is not null and r.score_final > s.maximum group by all")
def above_maximum(spark: SparkSession, d: str) -> DataFrame:
    """Scores above what a system allows for the level, by the seeded standards."""
    s = maintenance.seeded(spark.createDataFrame([], "country string, system string, level string, maximum double, has_d boolean"), list(config.SCORING_STANDARDS), ["country", "system", "level"])
    r = table(spark, d, "results_v2").select("level", "score_final").join(broadcast_if_small(s), "level")
    return r.filter("score_final > maximum").groupBy("level", "country", "system", "maximum").agg(F.count(F.lit(1)).alias("n"))


@query("""select result_id, case when json_valid(details_json) then json_extract_string(details_json, '$.Squad') end as "Squad", null::varchar as other, case when details_json is not null and not json_valid(details_json) then 'kept' when json_valid(details_json) and contains(details_json, '"Squad"') then 'taken' else 'same' end as bag from results_v2""")
def widened_rows(spark: SparkSession, d: str) -> DataFrame:
    """A newly allowed column comes out of the JSON bag; one that isn't allowed doesn't."""
    r = table(spark, d, "results_v2").select("result_id", "details_json")
    w = maintenance.widened(r.withColumn("was", F.col("details_json")), "details_json", {"Squad": "string", "Secret": "string"}, ("Squad",))
    readable = F.try_parse_json("was").isNotNull()
    bag = F.when(F.col("was").isNotNull() & ~readable, "kept").when(F.col("was").contains('"Squad"') & ~F.coalesce(F.col("details_json"), F.lit("")).contains('"Squad"'), "taken").otherwise("same")
    return w.select("result_id", "Squad", F.lit(None).cast("string").alias("other"), bag.alias("bag"))


# --- sinks ------------------------------------------------------------------------------------------
@query("select person_id, full_name from persons")
def appended_rows(spark: SparkSession, d: str) -> DataFrame:
    """Half a table, to which all rows are appended whose key isn't there, then swapped in place."""
    p, path = table(spark, d, "persons").select("person_id", "full_name"), scratch(spark, "append")
    sinks.replace_table(p.filter("person_id % 2 = 0"), path)
    sinks.append_new(p, path, ["person_id"])
    new = spark.read.parquet(path)
    sinks.swap_table(new, f"{path}-swapped", p.count())
    return spark.read.parquet(f"{path}-swapped")


@query("select club_id, name from clubs")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "csv")
    sinks.write_csv(table(spark, d, "clubs"), path)
    return spark.read.option("header", True).schema("club_id bigint, name string").csv(path)


@query("select meet_db_id, name, comp_year from meets")
def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "json")
    curation.as_json(table(spark, d, "meets").select("meet_db_id", "name", "comp_year")).write.text(path)
    return spark.read.schema("meet_db_id bigint, name string, comp_year int").json(path)


@query("select doc_id, substr(text, 1, 500) as message from documents where text is not null")
def cut_errors(spark: SparkSession, d: str) -> DataFrame:
    return sinks.error_rows(table(spark, d, "documents").filter("text is not null").select("doc_id", F.col("text").alias("message")), "message")


@query(f"select source, meet_id, status from {_STATUS}")
def status_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "status")
    sinks.write_csv(curation.status_rows(_status(spark, d)), path)
    return spark.read.option("header", True).schema("source string, meet_id string, status string").csv(path)


@query("select c_custkey, c_name, c_mktsegment as details, (c_acctbal < 0)::int as low from customer")
def folded_rows(spark: SparkSession, d: str) -> DataFrame:
    """Columns folded into a JSON object and read out of it again."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", (F.col("c_acctbal") < 0).cast("int").alias("low"), F.lit('{"old": 1}').alias("bag"))
    f = reshape.folded(c, ["c_custkey", "c_name"], "bag")
    at = lambda k: F.get_json_object("bag", f"$.{k}")
    return f.filter(at("old") == "1").select("c_custkey", "c_name", at("c_mktsegment").alias("details"), at("low").cast("int").alias("low"))


@query("select p1.full_name as canonical, p2.full_name as alias from persons p1 join persons p2 on p2.person_id = p1.person_id + 1 where p1.person_id % 3 != 0")
def decided_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases from what people decided: the first, the second or neither is canonical."""
    p = table(spark, d, "persons")
    c = p.select("person_id", F.col("full_name").alias("a")).join(p.select((F.col("person_id") - 1).alias("person_id"), F.col("full_name").alias("b")), "person_id")
    one = F.col("person_id") % 3 == 1
    c = c.select(F.when(one, F.col("a")).otherwise(F.col("b")).alias("name_1"), F.when(one, F.col("b")).otherwise(F.col("a")).alias("name_2"), F.lit("r").alias("reason"), (F.col("person_id") % 3).cast("int").alias("choice"))
    return curation.decided(c)[0].select("canonical", "alias")


# --- order and shape --------------------------------------------------------------------------------
@query("select gold_id, row_number() over (order by comp_year desc nulls last, athlete_name nulls first, gold_id) - 1 as place, (row_number() over (order by comp_year desc nulls last, athlete_name nulls first, gold_id) - 1) // 50 as chunk from gold_results_wag")
def ordered_gold(spark: SparkSession, d: str) -> DataFrame:
    """Gold rows by year, the latest first, and name, in chunks of fifty."""
    g = table(spark, d, "gold_results_wag").select("gold_id", "comp_year", "athlete_name")
    return order.numbered(g, [F.desc_nulls_last("comp_year"), F.asc_nulls_first("athlete_name"), "gold_id"], "place").select("gold_id", "place", F.floor(F.col("place") / 50).alias("chunk"))


@query("select meet_db_id, row_number() over (order by case source when 'mso' then 0 else 1 end, md5('7' || meet_db_id)) - 1 as place from meets")
def shuffled_queue(spark: SparkSession, d: str) -> DataFrame:
    """A queue with one site first and the rest shuffled by a seed; a hash, so that a lost task
    gives the same order again."""
    m = table(spark, d, "meets").select("meet_db_id", "source")
    return order.numbered(m, [F.when(F.col("source") == "mso", 0).otherwise(1), F.md5(F.concat(F.lit("7"), F.col("meet_db_id").cast("string")))], "place").select("meet_db_id", "place")


@query(f"select m.meet_db_id from meets m join {_STATUS} s on s.source = m.source and s.meet_id = m.source_meet_id where s.status = 'RETRYING' or m.name ilike '%championships%'")
def priority_meets(spark: SparkSession, d: str) -> DataFrame:
    """Meets of the manifest whose source and id are on a list."""
    m = table(spark, d, "meets").select("meet_db_id", "source", F.col("source_meet_id").alias("meet_id"), "name")
    listed = m.filter(F.col("name").ilike("%championships%")).select("source", "meet_id").unionByName(_status(spark, d).filter("status = 'RETRYING'").select("source", "meet_id")).distinct()
    return m.join(listed, ["source", "meet_id"], "left_semi").select("meet_db_id")


@query(r"""select result_id, coalesce(nullif(trim(level), ''), nullif(regexp_extract(group_name, '(?i)(Level\s*\d+|CCP\s*\d+|P\d+|CPP\s*\d+|Provincial\s*\d+|Junior\s*[A-Z]|Senior\s*[A-Z]|Xcel\s*[a-zA-Z]+)', 1), ''), '') as "Level", coalesce(nullif(trim(state), ''), province) as "Prov", meet as "Meet" from results_v2 where trim(coalesce(num, '')) != ''""")
def standard_columns(spark: SparkSession, d: str) -> DataFrame:
    """Levels told by the group's text, two columns of provinces made one, rows without a number
    left out, columns in standard order."""
    r = table(spark, d, "results_v2").filter(F.trim(F.coalesce("num", F.lit(""))) != "")
    return r.select("result_id", text.group_level(F.col("level"), F.col("group_name")).alias("Level"), F.coalesce(text.blank_to_null(F.col("state")), F.col("province")).alias("Prov"), F.col("meet").alias("Meet"))


_NUMBER = "case when regexp_full_match(trim({0}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then trim({0})::decimal(9,3) end"


@query("select gold_id, aa_d, round((" + " + ".join(f"coalesce({_NUMBER.format(f'''replace({p}_d, ',', '')''')}, 0)" for p in ("vt", "ub", "bb", "fx")) + ")::double, 3) as made from gold_results_wag where aa_d is null and (" + " or ".join(f"{_NUMBER.format(f'''replace({p}_d, ',', '')''')} is not null" for p in ("vt", "ub", "bb", "fx")) + ")")
def repaired_totals(spark: SparkSession, d: str) -> DataFrame:
    """All-around D of gold rows that lack it, from the apparatus' D."""
    g = table(spark, d, "gold_results_wag").filter("aa_d is null")
    ds = F.array_compact(F.array(*[text.to_float(F.col(f"{p}_d")).cast("decimal(9,3)") for p in ("vt", "ub", "bb", "fx")]))
    total = F.aggregate(ds, F.lit(0).cast("decimal(18,3)"), lambda a, x: (a + x).cast("decimal(18,3)"))
    return g.filter(F.size(ds) > 0).select("gold_id", "aa_d", F.round(total.cast("double"), 3).alias("made"))


@query("select p.person_id, g.gold_id from gold_results_wag g join persons p on contains(lower(g.athlete_name), lower(string_split(p.full_name, ' ')[1])) and contains(lower(g.athlete_name), lower(list_last(string_split(p.full_name, ' ')))) where p.person_id <= 20")
def two_part_matches(spark: SparkSession, d: str) -> DataFrame:
    """Gold rows whose name holds the first and the last word of a wanted one. The list of the
    wanted is a parameter (here the twenty people of the least ids), so it is broadcast."""
    w = F.split("full_name", " ")
    wanted = table(spark, d, "persons").filter("person_id <= 20").select("person_id", F.lower(w[0]).alias("first"), F.lower(F.element_at(w, -1)).alias("last"))
    g = table(spark, d, "gold_results_wag").select("gold_id", F.lower("athlete_name").alias("n"))
    return g.join(F.broadcast(wanted), F.col("n").contains(F.col("first")) & F.col("n").contains(F.col("last"))).select("person_id", "gold_id")


@query("select p.full_name as athlete, m.name as meet, f.source, count(*) as n, count(f.file_path) as in_ledger from persons p join athletes a using (person_id) join results_v2 r using (athlete_id) join meets m using (meet_db_id) left join processed_files f on f.file_path = r.source_file group by 1, 2, 3")
def athlete_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Results of each person per meet, and how many are of files the ledger knows."""
    r = table(spark, d, "results_v2").groupBy("athlete_id", "meet_db_id", "source_file").agg(F.count(F.lit(1)).alias("n"))
    a = table(spark, d, "athletes").select("athlete_id", "person_id").join(table(spark, d, "persons").select("person_id", F.col("full_name").alias("athlete")), "person_id")
    x = r.join(a, "athlete_id").join(broadcast_if_small(table(spark, d, "meets").select("meet_db_id", F.col("name").alias("meet"))), "meet_db_id")
    x = x.join(table(spark, d, "processed_files").select(F.col("file_path").alias("source_file"), "source"), "source_file", "left")
    return x.groupBy("athlete", "meet", "source").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("source").isNotNull(), F.col("n")).otherwise(0)).alias("in_ledger"))


_KNOWN = ("result_id", "meet_db_id", "athlete_id", "apparatus_id", "gender", "level", "age", "province", "score_d", "score_final", "score_text", "rank_numeric", "rank_text", "details_json", "age_group", "meet", "state", "session", "num", "bonus", "execution_bonus")


@query("select k.key as header, count(*) as n, count(distinct source_file) as files from results_v2, json_each(case when json_valid(details_json) then details_json::json end) k where k.type != 'NULL' and lower(k.key) not in (" + ", ".join(f"'{c}'" for c in (*_KNOWN, *[a.lower() for a in config.COLUMN_ALIASES])) + ") group by 1")
def unmapped_columns(spark: SparkSession, d: str) -> DataFrame:
    """Headers that no column and no alias takes."""
    from ..operators import drift

    known = small_table(spark, [(c,) for c in (*_KNOWN, *[a.lower() for a in config.COLUMN_ALIASES])], "low string").distinct()
    rows = table(spark, d, "results_v2").select("source_file", "details_json")
    v = drift.field_texts(rows, "source_file", "details_json")
    left = v.withColumn("low", F.lower("field")).join(broadcast_if_small(known), "low", "left_anti")
    return left.groupBy(F.col("field").alias("header")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file").alias("files"))


_TABLES = ("results_v2", "meets", "persons", "clubs", "athletes", "apparatus", "processed_files", "gold_results_wag")
_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz"}


@query("select table_name, column_name, case data_type " + " ".join(f"when '{a}' then '{b}'" for a, b in _TYPES.items()) + " else data_type end as kind, ordinal_position - 1 as place from information_schema.columns where table_name in (" + ", ".join(f"'{t}'" for t in _TABLES) + ")")
def table_schemas(spark: SparkSession, d: str) -> DataFrame:
    rows = [(t, f.name, f.dataType.simpleString(), i) for t in _TABLES for i, f in enumerate(table(spark, d, t).schema)]
    return small_table(spark, rows, "table_name string, column_name string, kind string, place int")


_SERVICE = ["age_group", "group_name", "state", "session", "num", "bonus", "score_sv", "penalty"]


@query(" union all ".join(f"select '{c}' as column_name, v::varchar as value from (select distinct {c}::varchar as v from results_v2 where trim(coalesce({c}::varchar, '')) != '' order by v limit 5)" for c in _SERVICE))
def column_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first five different values of each service column, from one scan."""
    r = table(spark, d, "results_v2").select(*_SERVICE)
    each = r.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in _SERVICE])).alias("x")).select("x.*").filter("trim(value) != ''").distinct()
    return star.first_kept(each, ["column_name"], [F.asc("value")], 5)


@query("select column_name, in_facts, in_gold from (" + " union all ".join(f"select '{c}' as column_name, count({f}) > 0 as in_facts, {g} as in_gold from results_v2" for c, f, g in (("level", "level", "(select count(level) > 0 from gold_results_wag)"), ("age", "age", "(select count(age) > 0 from gold_results_wag)"), ("province", "province", "false"), ("num", "num", "false"), ("penalty", "penalty", "false"))) + ") where in_facts and not in_gold")
def audit_gold_columns(spark: SparkSession, d: str) -> DataFrame:
    """Filled fact columns that gold has no filled column for."""
    r, g = table(spark, d, "results_v2"), table(spark, d, "gold_results_wag")
    names = ["level", "age", "province", "num", "penalty"]
    both = [c for c in names if c in g.columns]
    facts = r.agg(*[F.count(c).alias(c) for c in names])
    gold = g.agg(*[F.count(c).alias(c) for c in both])
    long = lambda df, cs: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col(c) > 0).alias("there")) for c in cs])).alias("x")).select("x.*")
    out = long(facts, names).join(long(gold, both).withColumnRenamed("there", "in_gold"), "column_name", "left")
    return out.select("column_name", F.col("there").alias("in_facts"), F.coalesce("in_gold", F.lit(False)).alias("in_gold")).filter("in_facts and not in_gold")


_CASES = {"SNG": "Senior Next Gen", "srng": "Senior Next Gen", "SR-NG": "Senior Next Gen", "asp": "Aspire", "AP": "Aspire", "J16-18": "J16-18", "junior 16-18": "Junior (16-18)", "b1a": "P1A", "E3": "Elite 3", " P9 ": "P9", "NOV": "Novice", "M1516": "Junior (15-16)"}


@query("select * from (values " + ", ".join(f"('{a}', '{c}')" for a, c in _CASES.items()) + ") t(typed, level)")
def level_cases(spark: SparkSession, d: str) -> DataFrame:
    """Twelve levels as typed, and what they must become."""
    df = small_table(spark, [(a, a) for a in _CASES], "typed string, level string")
    return resolve.through_aliases(df, "level", _aliases(spark, config.LEVELS), any_case=True).select("typed", "level")


# --- streams ----------------------------------------------------------------------------------------
@query("select file_path, file_hash from processed_files")
def streamed_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Files taken in once by content: the ledger is streamed twice over, the second time all is known."""
    path, src = scratch(spark, "intake"), scratch(spark, "arrivals")
    f = table(spark, d, "processed_files").select("file_path", "file_hash")
    f.write.parquet(src)
    for turn in range(2):
        f.write.mode("append").parquet(src) if turn else None
        stream = intake.table_stream(spark, src, f.schema)
        intake.run_available(stream, "ledger", path, each=lambda batch, _: intake.take_in(batch, f"{path}/known", "file_hash"))
    return spark.read.parquet(f"{path}/known").select("file_path", "file_hash")


@query("select event_id, user_id, event_type from events")
def stream_of_repeats(spark: SparkSession, d: str) -> DataFrame:
    """A stream in which a third of the events comes twice: the first of each wins; what comes again comes within two hours."""
    src, out = scratch(spark, "twice"), scratch(spark, "once")
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    e.unionByName(e.filter("event_id % 3 = 0").withColumn("ts", F.col("ts") + F.expr("interval 1 hour"))).repartition(4).write.parquet(src)
    intake.run_available(intake.first_wins(intake.table_stream(spark, src, spark.read.parquet(src).schema), ["event_id"], "ts", "2 hours").select("event_id", "user_id", "event_type"), "once", out)
    return spark.read.parquet(f"{out}/once")


@query("select date_trunc('day', ts)::timestamp as start, event_type, count(*) as n from events group by 1, 2")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Counts per day and kind over the stream; an event far ahead closes the last window."""
    src, out = scratch(spark, "days"), scratch(spark, "windows")
    e = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    run = lambda: intake.run_available(intake.windowed_counts(intake.table_stream(spark, src, e.schema), "ts", "1 day", "1 day", ["event_type"]), "days", out)
    e.write.parquet(src)
    run()
    for _ in range(2):  # the watermark of one batch closes windows in the next
        spark.createDataFrame([(dt.datetime(2100, 1, 1), "end")], e.schema).write.mode("append").parquet(src)
        run()
    return spark.read.parquet(f"{out}/days").filter("event_type != 'end'").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("select source, 1 + (count(*) - 1) // 40 as batches, count(*) as rows from meets where source = 'livemeet' group by 1")
def queue_batches(spark: SparkSession, d: str) -> DataFrame:
    """A queue worked off forty entries at a time, with the progress of each batch."""
    out = scratch(spark, "queue")
    m = table(spark, d, "meets").filter("source = 'livemeet'").select("meet_db_id", "source")
    q = order.numbered(m, ["meet_db_id"], "place").withColumn("batch", F.floor(F.col("place") / 40))
    q.repartition("batch").write.partitionBy("batch").parquet(out)
    done = intake.progress(intake.run_available(intake.table_stream(spark, out, "meet_db_id bigint, source string, place bigint, batch int", 1), "work", f"{out}-done"))
    rows = spark.createDataFrame([(int(p["rows"]),) for p in done if p["rows"]], "rows bigint")
    return spark.read.parquet(f"{out}-done/work").groupBy("source").agg(F.countDistinct("batch").alias("batches")).crossJoin(rows.agg(F.sum("rows").alias("rows")))  # one row each
