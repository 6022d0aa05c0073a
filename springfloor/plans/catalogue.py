"""Queries that exercise the operators on whole tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config
from ..functions import dates, text
from ..operators import candidates, order, reshape, resolve, sinks, star
from ..runtime import broadcast_if_small, small_table, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query and, if it has one, its SQL twin."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _star(spark: SparkSession, d: str) -> DataFrame:
    return star.star(*[table(spark, d, t) for t in ("results_v2", "athletes", "persons", "clubs", "meets", "apparatus")])


_STAR_SQL = """(select r.*, a.person_id, p.full_name as athlete_name, c.name as club, m.name as meet_name, m.comp_year, m.start_date_iso as meet_date, m.source, x.name as apparatus
  from results_v2 r join athletes a using (athlete_id) join persons p using (person_id) left join clubs c using (club_id) join meets m using (meet_db_id) join apparatus x using (apparatus_id))"""


def _gold_sql(gender: str) -> str:
    cells = []
    for p, name in config.GOLD_ORDER[gender]:
        f = f"filter (apparatus = '{name}')"
        cells.append(f"nullif(coalesce(round(max(score_final) {f}, 3)::varchar, max(score_text) {f}), '') as {p}_score")
        cells.append(f"nullif(coalesce(round(max(score_d) {f}, 3)::varchar, max(case when json_valid(details_json) then json_extract_string(details_json, '$.score_d_text') end) {f}), '') as {p}_d")
        cells.append(f"nullif(coalesce((min(rank_numeric) {f})::varchar, max(rank_text) {f}), '') as {p}_rank")
    named = "case when coalesce(trim(session), '') != '' then meet_name || ' (' || session || ')' else meet_name end"
    return f"""select person_id, meet_db_id, session, min(athlete_name) as athlete_name, min(comp_year) as comp_year, min(meet_date) as meet_date, min({named}) as meet_name, min(level) as level, max(age)::varchar as age, min(club) as club, {", ".join(cells)}
  from {_STAR_SQL} where gender = '{gender}' group by person_id, meet_db_id, session having max(score_final) is not null"""


@query(_gold_sql("F"))
def gold_wag(spark: SparkSession, d: str) -> DataFrame:
    return star.gold(_star(spark, d), "F")


@query(_gold_sql("M"))
def gold_mag(spark: SparkSession, d: str) -> DataFrame:
    return star.gold(_star(spark, d), "M")


@query(f"select source, apparatus, count(*) as n, count(club) as with_club, max(score_final) as best from {_STAR_SQL} group by 1, 2")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    return _star(spark, d).groupBy("source", "apparatus").agg(F.count(F.lit(1)).alias("n"), F.count("club").alias("with_club"), F.max("score_final").alias("best"))


@query("select l_orderkey, l_linenumber, case when l_discount > 0.05 then l_returnflag || ' (' || l_linestatus || ')' else l_returnflag end as flag from lineitem where l_shipdate >= '1995-01-01' and l_shipdate < '1996-01-01' and lower(l_returnflag) like 'r%'")
def scan_filter_project(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").filter((F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")) & F.col("l_returnflag").ilike("r%"))
    return x.select("l_orderkey", "l_linenumber", F.when(F.col("l_discount") > 0.05, F.concat("l_returnflag", F.lit(" ("), "l_linestatus", F.lit(")"))).otherwise(F.col("l_returnflag")).alias("flag"))


@query(f"select person_id, club, apparatus, count(*) as n, round(avg(score_final::decimal(18,3))::double, 3) as mean, max(score_final) as best, min(score_final) as worst from {_STAR_SQL} where score_final is not null group by 1, 2, 3")
def entity_summary(spark: SparkSession, d: str) -> DataFrame:
    s = _star(spark, d).filter("score_final is not null")
    mean = F.round((F.sum(F.col("score_final").cast("decimal(18,3)")) / F.count("score_final")).cast("double"), 3)
    return s.groupBy("person_id", "club", "apparatus").agg(F.count(F.lit(1)).alias("n"), mean.alias("mean"), F.max("score_final").alias("best"), F.min("score_final").alias("worst"))


_LISTED = "(select meet_db_id, name, comp_year from meets union all select 1000000 + min(gold_id), trim(meet_name), comp_year from gold_results_wag group by trim(meet_name), comp_year)"


@query(f"select lower(trim(name)) as key, comp_year, min(meet_db_id) as first_id, string_agg(meet_db_id::varchar, ',' order by meet_db_id) as ids, count(*) as n from {_LISTED} group by 1, 2 having count(*) > 1")
def duplicate_meets(spark: SparkSession, d: str) -> DataFrame:
    """Meets of one name and year among the meets and those that gold names."""
    g = table(spark, d, "gold_results_wag").groupBy(F.trim("meet_name").alias("name"), "comp_year").agg((F.min("gold_id") + 1000000).alias("meet_db_id"))
    listed = table(spark, d, "meets").select("meet_db_id", "name", "comp_year").unionByName(g)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("meet_db_id")), lambda x: x.cast("string")), ",")
    return listed.groupBy(F.lower(F.trim("name")).alias("key"), "comp_year").agg(F.min("meet_db_id").alias("first_id"), ids.alias("ids"), F.count(F.lit(1)).alias("n")).filter("n > 1")


_UNIFY = """(with m as (select meet_db_id, case when name is null or lower(name) like '%unnamed:%' then '#' || meet_db_id else lower(trim(name)) end as n, coalesce(comp_year, try_cast(nullif(regexp_extract(name, '(20[0-9]{2})', 1), '') as int)) as y from meets)
  select meet_db_id, min(meet_db_id) over (partition by n, y) as canonical from m)"""


@query(f"select coalesce(u.canonical, r.meet_db_id) as meet_db_id, count(*) as n from results_v2 r left join {_UNIFY} u using (meet_db_id) group by 1")
def unified_facts(spark: SparkSession, d: str) -> DataFrame:
    mapping = resolve.unified(table(spark, d, "meets"), "meet_db_id", "name", "comp_year")
    return resolve.repointed(table(spark, d, "results_v2").select("meet_db_id"), "meet_db_id", mapping, "meet_db_id").groupBy("meet_db_id").agg(F.count(F.lit(1)).alias("n"))


_BLANK = "coalesce(trim({c}), '') = ''"
_LEAD = "coalesce(try_cast(nullif(regexp_extract({c}, '^\\s*([+-]?[0-9]+)', 1), '') as int), 0)"


def _propagated(c: str) -> str:
    blank, lead = _BLANK.format(c=c), _LEAD.format(c=c)
    nolevel = "(coalesce(trim(level), '') = '' or lower(trim(level)) in ('nan', 'none'))"
    best = f"min(case when not ({blank}) then {lead} end)"
    return f"case when {blank} then coalesce(case when meet_date is not null and not {nolevel} then {best} over (partition by athlete_name, meet_date, level) end, case when meet_date is not null and {nolevel} then {best} over (partition by athlete_name, meet_date) end)::varchar else {c} end as {c}"


@query("select gold_id, " + ", ".join(_propagated(f"{p}_rank") for p in ("vt", "ub", "bb", "fx", "aa")) + " from gold_results_wag")
def rank_propagation(spark: SparkSession, d: str) -> DataFrame:
    ranks = [f"{p}_rank" for p, _ in config.GOLD_ORDER["F"]]
    return star.propagate_ranks(table(spark, d, "gold_results_wag"), ranks).select("gold_id", *ranks)


_GOLD_COLUMNS = ["gold_id", "athlete_name", "comp_year", "meet_date", "meet_name", "level", "age", "club", *[f"{p}_{x}" for p in ("vt", "ub", "bb", "fx", "aa") for x in ("score", "d", "rank")], "source", "updated_at"]


@query("select gold_id from gold_results_wag qualify row_number() over (partition by athlete_name, meet_date, level, age order by " + " + ".join(f"({c} is not null)::int" for c in _GOLD_COLUMNS) + " desc, gold_id) = 1")
def fullest_rows(spark: SparkSession, d: str) -> DataFrame:
    return star.fullest_kept(table(spark, d, "gold_results_wag"), ["athlete_name", "meet_date", "level", "age"], "gold_id").select("gold_id")


@query("select result_id from results_v2 qualify row_number() over (partition by meet_db_id, athlete_id, apparatus_id, session, level order by loaded_at, source_file, result_id) = 1")
def first_results(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "results_v2")
    return star.first_kept(r.select("result_id", "meet_db_id", "athlete_id", "apparatus_id", "session", "level", "loaded_at", "source_file"), ["meet_db_id", "athlete_id", "apparatus_id", "session", "level"], [F.col(c) for c in ("loaded_at", "source_file", "result_id")]).select("result_id")


@query("with c as (select distinct meet_name, level, age from gold_results_wag where athlete_name in (select full_name from persons where dob like '2010%')) select gold_id from gold_results_wag g where exists (select 1 from c where c.meet_name is not distinct from g.meet_name and c.level is not distinct from g.level and c.age is not distinct from g.age)")
def session_peers(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the meets, levels and ages of a roster: here the people born in 2010."""
    g = table(spark, d, "gold_results_wag")
    roster = table(spark, d, "persons").filter(F.col("dob").startswith("2010")).select(F.col("full_name").alias("athlete_name"))
    return star.peers(g, g.join(broadcast_if_small(roster), "athlete_name", "left_semi"), ["meet_name", "level", "age"]).select("gold_id")


@query("select meet_db_id from meets m where not exists (select 1 from results_v2 r where r.meet_db_id = m.meet_db_id and r.level = 'Gold')")
def meets_without_results(spark: SparkSession, d: str) -> DataFrame:
    """Meets without a result of a level."""
    return table(spark, d, "meets").join(table(spark, d, "results_v2").filter("level = 'Gold'").select("meet_db_id"), "meet_db_id", "left_anti").select("meet_db_id")


_ALIASES = tuple(config.LEVELS.items())
_ALIAS_SQL = "(values " + ", ".join(f"('{a}', '{c}', {i})" for i, (a, c) in enumerate(_ALIASES)) + ") t(alias, canonical, pos)"


@query(f"""with a as (select * from {_ALIAS_SQL}), e as (select alias, arg_min(canonical, pos) as c1 from a group by 1), l as (select lower(regexp_replace(alias, '\\s+', '', 'g')) as k, arg_min(canonical, pos) as c2 from a group by 1)
  select coalesce(c1, c2, trim(level)) as level, count(*) as n from results_v2 r left join e on e.alias = r.level left join l on l.k = lower(regexp_replace(r.level, '\\s+', '', 'g')) group by 1""")
def alias_levels(spark: SparkSession, d: str) -> DataFrame:
    a = small_table(spark, [(x, c, i) for i, (x, c) in enumerate(_ALIASES)], "alias string, canonical string, pos int")
    return resolve.through_aliases(table(spark, d, "results_v2").select("level"), "level", a, any_case=True).groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("""with w as (select club_id, unnest(list_distinct(list_filter(string_split(regexp_replace(lower(name), '[^a-z]+', ' ', 'g'), ' '), lambda x: length(x) > 3 and x not in ('gymnastics', 'club', 'academy', 'centre', 'center', 'school', 'association', 'athletic', 'fitness')))) as word from clubs)
  select a.club_id as club_a, b.club_id as club_b, count(*) as common from w a join w b using (word) where a.club_id < b.club_id group by 1, 2 having count(*) >= 2""")
def word_overlap(spark: SparkSession, d: str) -> DataFrame:
    words = F.split(F.regexp_replace(F.lower("name"), "[^a-z]+", " "), " ")
    common = ("gymnastics", "club", "academy", "centre", "center", "school", "association", "athletic", "fitness")
    c = table(spark, d, "clubs").select("club_id", F.array_distinct(F.filter(words, lambda x: (F.length(x) > 3) & ~x.isin(*common))).alias("words"))
    return candidates.overlapping(c, "club_id", "words", 2).select(F.col("a").alias("club_a"), F.col("b").alias("club_b"), "common")


@query("select athlete_id, result_id, score_final from results_v2 where score_final is not null qualify row_number() over (partition by athlete_id order by score_final desc, result_id) <= 5")
def best_five(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("athlete_id").orderBy(F.desc("score_final"), "result_id")
    x = table(spark, d, "results_v2").filter("score_final is not null").select("athlete_id", "result_id", "score_final").withColumn("n", F.row_number().over(w))
    return x.filter("n <= 5").drop("n")


_AA = "coalesce(try_cast(trim(aa_score) as decimal(9,3)), 0)"
_LIKE = lambda *xs: "(" + " or ".join(f"meet_name ilike '%{x}%'" for x in xs) + ")"


_DAYS = "(select athlete_name, meet_date, level, meet_name || x.s as meet_name, (try_cast(case when regexp_full_match(trim(aa_score), '[0-9.]+') then trim(aa_score) end as decimal(9,3)) * x.f)::decimal(9,2)::varchar as aa_score from gold_results_wag, (values (' Day 1', 1.0), (' (Jour 2)', 2.0), ('', 3.0)) x(s, f))"


@query(f"""select athlete_name, meet_date, level, d1::double as d1, d2::double as d2, combined::double as combined, abs(d1 + d2 - combined) <= 0.1 as agrees from (select athlete_name, meet_date, level,
  max(case when {_LIKE("Day 1", "Jour 1", " D1")} then {_AA} else 0 end) as d1, max(case when {_LIKE("Day 2", "Jour 2", " D2")} then {_AA} else 0 end) as d2, max(case when not {_LIKE("Day", "Jour", " D1", " D2")} then {_AA} else 0 end) as combined
  from {_DAYS} group by 1, 2, 3) where d1 > 0 and d2 > 0 and combined > 0""")
def multi_day_totals(spark: SparkSession, d: str) -> DataFrame:
    """Two days and a combined total, made of each row: one, two and three times its score."""
    g = table(spark, d, "gold_results_wag")
    days = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.lit(k).cast("decimal(2,1)").alias("f")) for s, k in ((" Day 1", 1), (" (Jour 2)", 2), ("", 3))])).alias("x")
    score = F.when(F.trim("aa_score").rlike("^[0-9.]+$"), F.trim("aa_score").try_cast("decimal(9,3)"))
    x = g.select("athlete_name", "meet_date", "level", "meet_name", score.alias("a"), days)
    return star.multi_day_totals(x.select("athlete_name", "meet_date", "level", F.concat("meet_name", "x.s").alias("meet_name"), (F.col("a") * F.col("x.f")).cast("decimal(9,2)").cast("string").alias("aa_score")))


@query("select gold_id, apparatus, nullif(trim(score), '') as score, nullif(trim(d), '') as d, nullif(trim(rank), '') as rank from (" + " union all ".join(f"select gold_id, '{n}' as apparatus, {p}_score as score, {p}_d as d, {p}_rank as rank from gold_results_wag" for p, n in config.GOLD_ORDER["F"]) + ") where nullif(trim(score), '') is not null or nullif(trim(d), '') is not null")
def unpivoted_scores(spark: SparkSession, d: str) -> DataFrame:
    return _long_gold(spark, d).select("gold_id", "apparatus", "score", "d", "rank")


def _long_gold(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gold_results_wag")
    part = {"score": "Score", "d": "D", "rank": "Rnk"}
    wide = g.select("gold_id", *[F.col(f"{p}_{x}").alias(f"Result_{n}_{y}") for p, n in config.GOLD_ORDER["F"] for x, y in part.items()])
    return reshape.unpivot_results(wide, ["gold_id"])


_NUM = "coalesce(regexp_full_match(trim({c}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'), false)"
_SCR = "coalesce(upper(trim({c})) in ('S', 'DNS', 'SCRATCH', 'SCR', 'WD', 'SC') or upper(trim({c})) like 'SCR%', false)"


_N = lambda c: _NUM.format(c=f"replace({c}, ',', '')")


@query(f"""with u as ({SQL["unpivoted_scores"]}), s as (select *, {_N("d")} and not {_N("score")} and not {_SCR.format(c="score")} as swap from u), f as (select *, case when swap then d else score end as fin from s)
  select gold_id, apparatus, case when {_N("fin")} then trim(replace(fin, ',', ''))::double end as score_final, case when not {_N("fin")} then fin end as score_text, case when {_N("d")} then trim(replace(d, ',', ''))::double end as score_d,
  case when rank is null and not {_N("score")} and score is not null then score else rank end as rank_text from f""")
def settled_scores(spark: SparkSession, d: str) -> DataFrame:
    return reshape.settled_scores(_long_gold(spark, d)).select("gold_id", "apparatus", "score_final", "score_text", "score_d", "rank_text")


@query("select gold_id, metric, vt, ub, bb, fx, aa from (" + " union all ".join(f"select gold_id, '{m}' as metric, " + ", ".join(f"{p}_{x} as {p}" for p in ("vt", "ub", "bb", "fx", "aa")) + " from gold_results_wag" for m, x in (("Final Score", "score"), ("D Score", "d"), ("Rank", "rank"))) + ")")
def score_grid(spark: SparkSession, d: str) -> DataFrame:
    return reshape.grid(table(spark, d, "gold_results_wag"), ["gold_id"], "F")


@query("select event_type, json_extract_string(props, '$.k') as k, count(*) as n from events group by 1, 2")
def json_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("select meet_db_id, coalesce(comp_year, try_cast(nullif(regexp_extract(start_date_iso, '(20[0-9]{2})', 1), '') as int), try_cast(nullif(regexp_extract(name, '(20[0-9]{2})', 1), '') as int)) as comp_year from meets")
def filled_years(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meets").select("meet_db_id", F.coalesce("comp_year", text.year_of(F.col("start_date_iso")), text.year_of(F.col("name"))).alias("comp_year"))


_FORMATS = ["%b %d, %Y", "%B %d, %Y", "%d %b %Y", "%d %B %Y", "%m/%d/%Y", "%d/%m/%Y"]


def _iso(c: str) -> str:
    last = f"trim(list_last(string_split(trim({c}), ' - ')))"
    return f"case when {c} is null or trim({c}) = '' then {c} when regexp_full_match(trim({c}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') then trim({c}) else coalesce(" + ", ".join(f"strftime(try_strptime({last}, '{f}'), '%Y-%m-%d')" for f in _FORMATS) + f", {last}) end"


@query(f"select meet_db_id as id, {_iso('start_date_iso')} as day from meets union all select gold_id, {_iso('meet_date')} from gold_results_wag")
def iso_dates(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meets").select(F.col("meet_db_id").alias("id"), dates.iso_date(F.col("start_date_iso")).alias("day"))
    return m.unionByName(table(spark, d, "gold_results_wag").select(F.col("gold_id").alias("id"), dates.iso_date(F.col("meet_date")).alias("day")))


@query("select result_id, try_cast(nullif(regexp_replace(rank_text, '[^0-9]', '', 'g'), '') as int) as digits, case when rank_text is not null then " + _LEAD.format(c="rank_text") + " end as leading from results_v2 where rank_text is not null")
def parsed_ranks(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "results_v2").filter("rank_text is not null")
    return r.select("result_id", text.parse_rank(F.col("rank_text")).alias("digits"), text.leading_int(F.col("rank_text")).alias("leading"))


@query("select club_id, nullif(array_to_string(list_transform(regexp_extract_all(lower(trim(name)), '(\\pL+|[^\\pL]+)'), lambda x: upper(x[1]) || lower(x[2:])), ''), '') as title from clubs")
def club_titles(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clubs").select("club_id", text.title_case(F.col("name")).alias("title"))


@query("""with t as (select person_id, full_name as raw, regexp_replace(trim(regexp_replace(full_name, '\\s+', ' ', 'g')), '^([^,]*?)\\s*,\\s*(.*)$', '\\2 \\1') as s from persons),
  w as (select person_id, raw, list_transform(string_split(trim(s), ' '), lambda w: case when regexp_matches(w, '\\pL') and (w = upper(w) or w = lower(w)) then upper(w[1]) || lower(w[2:]) else w end) as ws from t)
  select person_id, case when lower(trim(raw)) not in ('#', 'name', 'athlete', 'competitor', 'gymnast', 'nan', '') and length(trim(raw)) > 1 and not regexp_full_match(trim(raw), '[0-9]+') and not contains(lower(raw), 'unnamed:')
  then array_to_string(list_filter(ws, lambda w, i: i = 1 or i = len(ws) or length(replace(w, '.', '')) > 1), ' ') end as name from w""")
def standard_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "persons").select("person_id", text.athlete_name(F.col("full_name")).alias("name"))


_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"


@query(f"""select meet_db_id, case when lower(source) = 'kscore' then 'CAN' when first in {_IN(config.STATES)} then 'USA' when first is not null then 'CAN'
  when {" or ".join(f"contains(upper(location), '{x}')" for x in config.PROVINCES_IN_TEXT)} then 'CAN' when contains(upper(name), 'CANADIAN') or contains(upper(name), 'CANADA') then 'CAN' when contains(upper(name), 'USA') or contains(upper(name), 'AAU') then 'USA' end as country
  from (select *, list_filter(regexp_split_to_array(upper(trim(location)), '[,\\s]+'), lambda t: t in {_IN([*config.STATES, *config.PROVINCES])})[1] as first from meets)""")
def countries(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meets").select("meet_db_id", text.country(F.col("location"), F.col("source"), F.col("name")).alias("country"))


_WHOLE, _LINE = "(l_quantity::int)", "l_linenumber"


@query(f"""select l_orderkey, l_linenumber, case l_linenumber % 5 when 0 then {_WHOLE} + 0.5 when 1 then {_WHOLE} / 1000.0 + l_linenumber when 2 then {_WHOLE} / 1000.0 + l_linenumber when 3 then {_WHOLE} / 1000.0 + l_linenumber else {_WHOLE} + 0.25 end::double as score,
  case when l_linenumber % 5 >= 2 then l_linenumber || 'T' end as rank_text, case when l_linenumber % 5 = 3 then 0.5 end::double as bonus from lineitem""")
def mso_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of one to five words."""
    q, n = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string")
    rank = F.concat(n, F.lit("T"))
    cell = F.element_at(F.array(F.concat(q, F.lit(".5")), F.concat_ws(" ", q, n), F.concat_ws(" ", rank, q, n), F.concat_ws(" ", rank, q, n, F.lit("0.5")), F.concat_ws(" ", rank, F.lit("a b c"), F.concat(q, F.lit(".25")))), F.col("l_linenumber") % 5 + 1)
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", text.mso_cell(cell).alias("c"))
    return x.select("l_orderkey", "l_linenumber", "c.score", "c.rank_text", "c.bonus")


@query("""select result_id, array_to_string(list_filter([case when score_final < 0 then 'negative score' end, case when score_final > 9.5 and not contains(lower(a.name), 'all') then 'high score' end, case when score_d < 0 then 'negative D' end, case when score_d > 5.5 then 'high D' end], lambda x: x is not null), '; ') as warnings
  from results_v2 join apparatus a using (apparatus_id) where score_final < 0 or score_final > 9.5 and not contains(lower(a.name), 'all') or score_d < 0 or score_d > 5.5""")
def score_warnings(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "apparatus").select("apparatus_id", F.col("name").alias("apparatus"))
    r = table(spark, d, "results_v2").join(broadcast_if_small(a), "apparatus_id")
    return r.select("result_id", text.score_warnings(F.col("score_final"), F.col("score_d"), F.col("apparatus"), 9.5, 5.5).alias("warnings")).filter("warnings is not null")


@query(f"""with g as (select meet_db_id, athlete_id, bool_or(apparatus = 'All Around') as has, sum(score_final::decimal(9,3)) filter (apparatus != 'All Around') as s, sum(score_d::decimal(9,3)) filter (apparatus != 'All Around') as d from {_STAR_SQL} group by 1, 2)
  select meet_db_id, athlete_id, s::double as score_final, case when d > 0 then d::double end as score_d from g where not has and s is not null""")
def calculated_all_around(spark: SparkSession, d: str) -> DataFrame:
    rows = _star(spark, d).select("meet_db_id", "athlete_id", "apparatus", "score_final", "score_d")
    return reshape.with_all_around(rows, ["meet_db_id", "athlete_id"]).filter("calculated").select("meet_db_id", "athlete_id", "score_final", "score_d")


_TERM = "(case when coalesce(regexp_full_match(trim({0}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'), false) then trim({0})::double end)"
_GOLD_SCORES = [f"{p}_score" for p, _ in config.GOLD_ORDER["F"]]
_ITEM = "[" + ", ".join(f"struct_pack(t := coalesce(trim({c}), '') != '', v := {_TERM.format(c)}, s := {c})" for c in _GOLD_SCORES) + "]"
_SAME = "(coalesce(abs(k.s[i].v - x.s[i].v) < 0.005, false) or ((k.s[i].v is null or x.s[i].v is null) and coalesce(k.s[i].s = x.s[i].s, false) and (k.s[i].t or x.s[i].t)))"
_EQUAL = "list_sum([" + ", ".join(f"((k.s[{i}].t or x.s[{i}].t) and {_SAME.replace('[i]', f'[{i}]')})::int" for i in range(1, 6)) + "])"
_BOTH = "list_sum([" + ", ".join(f"(k.s[{i}].t or x.s[{i}].t)::int" for i in range(1, 6)) + "])"


@query(f"""with recursive r as (select gold_id, athlete_name as a, meet_date as d, {_ITEM} as s, {_TERM.format("aa_score")} as aa, (coalesce(lower(trim(level)), '') in ('', 'nan', 'none'))::int as l, coalesce(contains(meet_name, '(Combined)')::int, -1) as c from gold_results_wag),
  q as (select *, len(list_filter(s, lambda z: z.t)) as n from r), f as (select *, n > 0 and coalesce(trim(a), '') != '' and coalesce(trim(d), '') != '' as folds from q),
  o as (select a, d, struct_pack(g := gold_id, s := s, aa := aa) as x, row_number() over (partition by a, d order by n desc, l, c, gold_id) as i from f where folds),
  w as (select a, d, i, [x] as kept from o where i = 1
    union all select w.a, w.d, o.i, case when len(list_filter(w.kept, lambda k: coalesce(k.aa != 0 and o.x.aa != 0 and abs(k.aa - o.x.aa) < 0.005, false) or {_BOTH.replace("x.s", "o.x.s")} > 0 and ({_EQUAL.replace("x.s", "o.x.s")} >= 0.8 * {_BOTH.replace("x.s", "o.x.s")} or {_EQUAL.replace("x.s", "o.x.s")} >= 4 and {_EQUAL.replace("x.s", "o.x.s")} >= {_BOTH.replace("x.s", "o.x.s")} - 2))) > 0 then w.kept else list_append(w.kept, o.x) end
    from w join o on o.a = w.a and o.d = w.d and o.i = w.i + 1)
  select gold_id from f where not folds union all select unnest(list_transform(kept, lambda k: k.g)) from (select arg_max(kept, i) as kept from w group by a, d)""")
def similar_rows(spark: SparkSession, d: str) -> DataFrame:
    return star.similar_rows_kept(table(spark, d, "gold_results_wag"), "gold_id", _GOLD_SCORES, "aa_score").select("gold_id")


@query("with k as (select distinct athlete_name, meet_name from gold_results_wag where level = 'Gold' and athlete_name is not null and meet_name is not null) select athlete_name, meet_name, vt_score from gold_results_wag g where not exists (select 1 from k where k.athlete_name = g.athlete_name and k.meet_name = g.meet_name) union all select athlete_name, meet_name, '9.999' from k")
def manual_overlay(spark: SparkSession, d: str) -> DataFrame:
    """Records entered by hand in place of those of the athlete and meet: one for each of a level."""
    g = table(spark, d, "gold_results_wag").select("athlete_name", "meet_name", "level", "vt_score")
    manual = g.filter("level = 'Gold' and athlete_name is not null and meet_name is not null").select("athlete_name", "meet_name").distinct().withColumn("vt_score", F.lit("9.999"))
    return resolve.overlaid(g.drop("level"), manual, ["athlete_name", "meet_name"])


_MERGE = "(with k as (select person_id, lower(trim(regexp_replace(full_name, '\\s+', ' ', 'g'))) as n from persons) select person_id, min(person_id) over (partition by n) as canonical from k)"


@query(f"select distinct canonical as person_id, club_id from athletes join {_MERGE} using (person_id)")
def merged_persons(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "persons").select("person_id", F.lower(text.clean_text(F.col("full_name"))).alias("n"))
    mapping = p.join(p.groupBy("n").agg(F.min("person_id").alias("canonical")), "n").select("person_id", "canonical")
    merged = resolve.repointed(table(spark, d, "athletes").select("person_id", "club_id"), "person_id", mapping, "person_id")
    return resolve.links(merged, "person_id", "club_id").select("person_id", "club_id")


@query("""with s as (select source_meet_id as k, min(country) as c from meets where country is not null group by 1), r as (select source || '_' || source_meet_id as key, location from meets)
  select key, coalesce((select c from s where s.k = r.key), (select c from s where s.k = 'x_' || r.key), (select arg_max(c, length(k)) from s where starts_with(r.key, s.k) and length(s.k) < length(r.key))) as country from r""")
def healed_meets(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meets")
    rows = m.select(F.concat_ws("_", "source", "source_meet_id").alias("key"), F.lit(None).cast("string").alias("country"))
    return resolve.healed(rows, "key", m.filter("country is not null"), "source_meet_id", {"country": "country"}, "x_").select("key", "country")


@query(f"select meet_db_id, source from meets where try_cast({_iso('start_date_iso')} as date) between date '2023-06-01' - 400 and date '2023-06-01' + 2")
def date_window(spark: SparkSession, d: str) -> DataFrame:
    """Meets in a window before a day, dates in any notation; those without one are left out."""
    day, now = F.try_to_date(dates.iso_date(F.col("start_date_iso")), "yyyy-MM-dd"), F.lit("2023-06-01").cast("date")
    return table(spark, d, "meets").filter(day.between(F.date_sub(now, 400), F.date_add(now, 2))).select("meet_db_id", "source")


@query("select result_id from results_v2 qualify (row_number() over (order by result_id) - 1) % 10 = 0")
def every_tenth(spark: SparkSession, d: str) -> DataFrame:
    return order.every_nth(table(spark, d, "results_v2").select("result_id"), ["result_id"], 10)


@query("""select 'INSERT INTO "customer" ("c_custkey", "c_name", "c_mktsegment") VALUES (' || c_custkey || ', ''' || replace(c_name, '''', '''''') || ''', ''' || c_mktsegment || ''') ON CONFLICT DO NOTHING;' as statement from customer""")
def insert_statements(spark: SparkSession, d: str) -> DataFrame:
    return sinks.insert_statements(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), "customer", ("c_custkey",))


@query("select gold_id, try_cast(trim(vt_score) as double) as vt_score, try_cast(trim(aa_score) as double) as aa_score from gold_results_wag qualify row_number() over (partition by athlete_name, meet_name, level order by gold_id) = 1")
def export_rows(spark: SparkSession, d: str) -> DataFrame:
    return sinks.export_rows(table(spark, d, "gold_results_wag"), ("vt_score", "aa_score"), ["athlete_name", "meet_name", "level"], ["gold_id"]).select("gold_id", "vt_score", "aa_score")


@query("select gold_id, case when regexp_matches(trim(meet_name), '\\((?:[^()]|\\([^()]*\\))*\\)$') then trim(regexp_replace(trim(meet_name), '\\((?:[^()]|\\([^()]*\\))*\\)$', '')) else meet_name end as meet_name from gold_results_wag")
def names_without_suffix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold_results_wag").select("gold_id", text.without_suffix(F.col("meet_name")).alias("meet_name"))


@query("select source_file as file_path, 'h' || count(*) as file_hash, max(loaded_at) as last_processed from results_v2 group by 1")
def latest_ledger(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "results_v2").groupBy(F.col("source_file").alias("file_path")).agg(F.concat(F.lit("h"), F.count(F.lit(1)).cast("string")).alias("file_hash"), F.max("loaded_at").alias("last_processed"))
    return sinks.ledger(table(spark, d, "processed_files").withColumn("last_processed", F.lit("2000-01-01").cast("timestamp_ntz")).join(g.select("file_path"), "file_path", "left_semi"), g)


_STATUS = " ".join(f"when upper(trim(score_text)) in {_IN(xs)} then '{k}'" for k, xs in config.STATUS_WORDS.items())


@query(f"select case when score_text = '' then null {_STATUS} else score_text end as status, count(*) as n from results_v2 where score_text is not null group by 1")
def status_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "results_v2").filter("score_text is not null").groupBy(text.status_word(F.col("score_text")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("select meet_db_id, " + " or ".join(f"regexp_matches(lower(name), '{p}')" for p in config.OTHER_SPORT) + " as other_sport from meets where name is not null")
def other_sports(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "meets").filter("name is not null").select("meet_db_id", text.other_sport(F.col("name")).alias("other_sport"))


@query("select trim(regexp_replace(regexp_replace(lower(name), '\\b(gymnastics|club|gym|academy|centre|center)\\b', '', 'g'), '\\s+', ' ', 'g')) as core, min(club_id) as first_id, count(*) as n from clubs group by 1")
def club_cores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clubs").groupBy(text.club_core(F.col("name")).alias("core")).agg(F.min("club_id").alias("first_id"), F.count(F.lit(1)).alias("n"))


@query("""with b as (select meet_db_id, athlete_id, apparatus_id, string_agg(distinct k.key, ',' order by k.key) as fields from results_v2, json_each(case when json_valid(details_json) then details_json::json end) k where k.type != 'NULL' group by 1, 2, 3),
  f as (select meet_db_id, athlete_id, apparatus_id, first(score_final order by (details_json is null), result_id) filter (score_final is not null) as score_final, first(score_d order by (details_json is null), result_id) filter (score_d is not null) as score_d, first(rank_text order by (details_json is null), result_id) filter (rank_text is not null) as rank_text from results_v2 group by 1, 2, 3)
  select f.*, b.fields from f left join b on b.meet_db_id is not distinct from f.meet_db_id and b.athlete_id is not distinct from f.athlete_id and b.apparatus_id is not distinct from f.apparatus_id""")
def upgraded_results(spark: SparkSession, d: str) -> DataFrame:
    """One row per meet, athlete and apparatus, and which fields its merged JSON has."""
    keys = ["meet_db_id", "athlete_id", "apparatus_id"]
    r = table(spark, d, "results_v2").select(*keys, "result_id", "score_final", "score_d", "rank_text", "details_json")
    out = resolve.upgraded(r, keys, [F.col("details_json").isNull(), F.col("result_id")], "details_json")
    return out.select(*keys, "score_final", "score_d", "rank_text", F.array_join(F.array_sort(F.json_object_keys("details_json")), ",").alias("fields"))


@query("select x.name as apparatus, g.gender, coalesce(min(a.apparatus_id), min(o.apparatus_id)) as apparatus_id from (select distinct name from apparatus) x cross join (values ('M', 2), ('F', 1), ('X', 99)) g(gender, disc) left join apparatus a on a.name = x.name and a.discipline_id = g.disc left join apparatus o on o.name = x.name and o.discipline_id = 99 group by 1, 2 having coalesce(min(a.apparatus_id), min(o.apparatus_id)) is not null")
def apparatus_lookup(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "apparatus")
    genders = F.explode(F.array(*[F.struct(F.lit(g).alias("gender"), F.lit(i).alias("discipline_id")) for g, i in (("M", 2), ("F", 1), ("X", 99))])).alias("g")
    asked = a.select(F.col("name").alias("apparatus")).distinct().select("apparatus", genders).select("apparatus", "g.*")
    own = a.select(F.col("name").alias("apparatus"), "discipline_id", F.col("apparatus_id").alias("own"))
    other = a.filter("discipline_id = 99").select(F.col("name").alias("apparatus"), F.col("apparatus_id").alias("other"))
    x = asked.join(own, ["apparatus", "discipline_id"], "left").join(other, "apparatus", "left").select("apparatus", "gender", F.coalesce("own", "other").alias("apparatus_id"))
    return x.filter("apparatus_id is not null")


@query("select meet_db_id from meets where meet_db_id in (12, 13) or name ilike '%cup%' and comp_year >= 2020")
def meets_by_id_or_name(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meets").select("meet_db_id", "name", "comp_year")
    a, b = m.filter(F.col("meet_db_id").isin(12, 13)), m.filter(F.col("name").ilike("%cup%") & (F.col("comp_year") >= 2020))
    return a.select("meet_db_id").union(b.select("meet_db_id")).distinct()


@query("select result_id, coalesce(nullif(trim(session), ''), nullif(trim(group_name), '')) as session from results_v2")
def routed_sessions(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "results_v2").select("result_id", F.col("session").alias("Sess"), F.col("group_name").alias("Group"), F.col("num").alias("Bib"))
    return reshape.routed_metadata(r, ["Sess", "Group", "Bib"], {"Sess": "session", "Group": "group"}).select("result_id", "session")


@query("select event_type, count(*) as n, sum(value::decimal(18,4))::double as total from events where ts >= (select max(ts) - interval 30 day from events) group by 1")
def recent_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    last = e.agg(F.max("ts").alias("m"))
    return e.join(F.broadcast(last), F.col("ts") >= F.col("m") - F.expr("interval 30 days")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))  # one row


@query("select l_returnflag, l_linestatus, sum(l_quantity::decimal(18,2))::double as sum_qty, sum(l_extendedprice::decimal(18,2))::double as sum_price, count(*) as n from lineitem where l_shipdate <= '1998-09-02' group by 1, 2")
def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    s = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    return x.groupBy("l_returnflag", "l_linestatus").agg(s("l_quantity").alias("sum_qty"), s("l_extendedprice").alias("sum_price"), F.count(F.lit(1)).alias("n"))


@query("select n_name, sum(l_extendedprice::decimal(18,2))::double as revenue, count(distinct o_orderkey) as orders from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1")
def nation_revenue(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice")
    per_order = li.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("r"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(broadcast_if_small(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(broadcast_if_small(c), F.col("o_custkey") == F.col("c_custkey"))
    return per_order.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("n_name").agg(F.sum("r").cast("double").alias("revenue"), F.count(F.lit(1)).alias("orders"))


@query("select lower(trim(regexp_replace(full_name, '\\s+', ' ', 'g'))) as canonical, string_agg(distinct full_name, '|' order by full_name) as aliases from persons group by 1 having count(distinct full_name) > 1")
def alias_groups(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.curation import alias_groups as groups

    a = table(spark, d, "persons").select(F.col("full_name").alias("alias"), F.lower(text.clean_text(F.col("full_name"))).alias("canonical"))
    return groups(a).filter(F.size("aliases") > 1).select("canonical", F.array_join("aliases", "|").alias("aliases"))
