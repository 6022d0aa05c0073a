"""Queries of the data-quality problems kept in the core: p1, p5 and p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import badrows, drift, references
from ..runtime import broadcast_if_small, materialize, table


def _schemas(spark: SparkSession, d: str) -> DataFrame:
    return drift.file_schemas(table(spark, d, "results_v2"), "source_file", "details_json", ("session",))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d, _schemas(spark, d))


def p1_schemas(spark: SparkSession, d: str) -> DataFrame:
    return _schemas(spark, d).select("file", "field", "type", "n")


_KEPT = ("result_id", "meet_db_id", "athlete_id", "apparatus_id", "gender", "level", "age", "province", "score_d", "score_final", "score_text", "rank_numeric", "rank_text", "age_group", "meet", "group_name", "state", "num", "bonus", "execution_bonus", "score_sv", "score_e", "penalty", "source_file", "loaded_at")


def _changes(spark: SparkSession, d: str, schemas: DataFrame) -> DataFrame:
    return drift.schema_changes(schemas, table(spark, d, "processed_files"), "file_path", "feed", "file_seq")


def p1_unified(spark: SparkSession, d: str) -> DataFrame:
    """Every row with all its columns; fields that the change log finds renamed are one column."""
    schemas = materialize(_schemas(spark, d))
    names = drift.rename_groups(schemas, _changes(spark, d, schemas), ("session",))
    one = schemas.withColumn("field", F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("field")))
    return drift.unified(table(spark, d, "results_v2"), "details_json", drift.union_schema(one), _KEPT, names=names, extra=("session",))


def p1_differences(spark: SparkSession, d: str) -> DataFrame:
    """The changes with each renamed field as one removed and one added."""
    c = _changes(spark, d, materialize(_schemas(spark, d)))
    apart = F.when(F.col("change_kind") == "renamed", F.array(F.struct(F.lit("removed").alias("k"), F.col("field_before").alias("x"), F.lit("").alias("y")), F.struct(F.lit("added").alias("k"), F.lit("").alias("x"), F.col("field_after").alias("y")))).otherwise(F.array(F.struct(F.col("change_kind").alias("k"), F.col("field_before").alias("x"), F.col("field_after").alias("y"))))
    return c.select("feed", "file_seq", F.explode(apart).alias("p")).select("feed", "file_seq", F.col("p.k").alias("change_kind"), F.col("p.x").alias("field_before"), F.col("p.y").alias("field_after"))


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return badrows.parse_lines(table(spark, d, "raw_results"), "raw_id", "raw_line")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return badrows.row_errors(_parsed(spark, d), "raw_id").select("raw_id")


def p5_reasons(spark: SparkSession, d: str) -> DataFrame:
    return badrows.row_errors(_parsed(spark, d), "raw_id").select("raw_id", F.array_join("reasons", ";").alias("reasons"))


def p5_valid(spark: SparkSession, d: str) -> DataFrame:
    parsed = _parsed(spark, d)
    return badrows.valid_rows(parsed, badrows.row_errors(parsed, "raw_id"), "raw_id")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    r = references.Reference
    refs = [
        r("athlete_id", ("athlete_id",), table(spark, d, "athletes"), ("athlete_id",), parent_time="created_at"),
        r("meet_db_id", ("meet_db_id",), table(spark, d, "meets"), ("meet_db_id",), parent_time="created_at"),
        r("apparatus_id", ("apparatus_id",), table(spark, d, "apparatus"), ("apparatus_id",)),
    ]
    return references.orphan_references(table(spark, d, "results_v2"), "result_id", refs, "loaded_at")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("result_id", "ref_column", "kind")


def p6_composite(spark: SparkSession, d: str) -> DataFrame:
    """Level and discipline of each result against the list of levels, as one key of two columns
    that may be null, under each of the three match semantics."""
    disciplines = table(spark, d, "apparatus").select("apparatus_id", F.when(F.col("discipline_id") != 99, F.col("discipline_id")).alias("discipline_id"))
    r = table(spark, d, "results_v2").select("result_id", "apparatus_id", "level").join(broadcast_if_small(disciplines), "apparatus_id", "left")
    levels = table(spark, d, "ref_levels")
    refs = [references.Reference(m, ("level", "discipline_id"), levels, ("level_name", "discipline_id"), match=m) for m in references.MATCHES]
    return references.orphan_references(r, "result_id", refs).select("result_id", "ref_column", "kind")


def p6_by_month(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_counts(_orphans(spark, d), {"athlete_id": "athletes", "meet_db_id": "meets", "apparatus_id": "apparatus"})


QUERIES = {f.__name__: f for f in (p1_found, p1_schemas, p1_unified, p5_found, p5_reasons, p5_valid, p6_found, p6_composite, p6_by_month, p1_differences)}

_P6 = """
  select result_id, 'athlete_id' as ref_column, case when a.athlete_id is null then 'missing' else 'late' end as kind, 'athletes' as parent_table, loaded_at
  from results_v2 r left join athletes a on a.athlete_id = r.athlete_id where r.athlete_id is not null and (a.athlete_id is null or a.created_at > r.loaded_at)
  union all
  select result_id, 'meet_db_id', case when m.meet_db_id is null then 'missing' else 'late' end, 'meets', loaded_at
  from results_v2 r left join meets m on m.meet_db_id = r.meet_db_id where r.meet_db_id is not null and (m.meet_db_id is null or m.created_at > r.loaded_at)
  union all
  select result_id, 'apparatus_id', 'missing', 'apparatus', loaded_at
  from results_v2 r left join apparatus p on p.apparatus_id = r.apparatus_id where r.apparatus_id is not null and p.apparatus_id is null
"""
_CELL = '(?:[^",]*|"(?:[^"]|"")*")'
_NUM = "[0-9]+([.][0-9]+)?"
_RANK = "(T?0*[1-9][0-9]*|0*[1-9][0-9]*T)?"
_OR_Q = lambda x: f'([ \\t]*{x}[ \\t]*|"[ \\t]*{x}[ \\t]*")'
_P5_VALID = ",".join([_CELL] * 5 + [_OR_Q(f"({_NUM})?"), _OR_Q(f"({_NUM}|DNS|DNF|SCR|WD)?"), _OR_Q(_RANK), _CELL])
_P5_HEADER = "MeetID,Athlete,Club,Level,Apparatus,D,Score,Rank,Session"

SQL = {
    "p5_found": f"select raw_id from raw_results where coalesce(raw_line, '') != '{_P5_HEADER}' and not coalesce(regexp_full_match(raw_line, '{_P5_VALID}'), false)",
    "p6_found": f"select result_id, ref_column, kind from ({_P6})",
    "p6_by_month": f"select parent_table, strftime(loaded_at, '%Y-%m') as month, kind, count(*) as n from ({_P6}) group by all",
    "p1_schemas": """
  with v as (
    select source_file as file, k.key as field, k.type as t
    from results_v2, json_each(case when json_valid(details_json) then details_json::json end) k where k.type != 'NULL'
    union all
    select source_file, 'session', case when regexp_full_match(session, '[0-9]+') then 'BIGINT' else 'VARCHAR' end from results_v2 where session is not null),
  w as (select file, field, case when t in ('BIGINT', 'UBIGINT', 'HUGEINT') then 'integer' when t = 'DOUBLE' then 'number' when t = 'VARCHAR' then 'string' else lower(t) end as t from v)
  select file, field, case when count(distinct t) = 1 then min(t) when count(distinct t) = 2 and min(t) = 'integer' and max(t) = 'number' then 'number' else 'string' end as type, count(*) as n
  from w group by file, field""",
}
_TYPED = """v as (
    select source_file as file, k.key as field, k.type as t, k.value::varchar as raw from results_v2, json_each(case when json_valid(details_json) then details_json::json end) k where k.type != 'NULL'
    union all select source_file, 'session', case when regexp_full_match(session, '[0-9]+') then 'BIGINT' else 'VARCHAR' end, session from results_v2 where session is not null),
  w as (select file, field, case when t in ('BIGINT', 'UBIGINT', 'HUGEINT') then 'integer' when t = 'DOUBLE' then 'number' when t = 'VARCHAR' then 'string' else lower(t) end as t, case when field != 'session' and t = 'VARCHAR' then json_extract_string(raw, '$') else raw end as raw from v),
  s as (select f.feed, f.file_seq as seq, field, case when count(distinct t) = 1 then min(t) when count(distinct t) = 2 and min(t) = 'integer' and max(t) = 'number' then 'number' else 'string' end as t from w join processed_files f on f.file_path = w.file group by all),
  n as (select feed, file_seq as seq from processed_files where feed is not null and file_seq is not null),
  p as (select n.feed, n.seq from n join n b on b.feed = n.feed and b.seq = n.seq - 1),
  c as (select p.feed, p.seq, coalesce(a.field, b.field) as field, a.t as ta, b.t as tb from p join (select feed, seq, field from s union select feed, seq + 1, field from s) k using (feed, seq) left join s a on a.feed = p.feed and a.seq = p.seq - 1 and a.field = k.field left join s b on b.feed = p.feed and b.seq = p.seq and b.field = k.field where a.t is distinct from b.t)"""
SQL["p1_differences"] = f"""with {_TYPED} select feed, seq as file_seq, case when ta is null then 'added' when tb is null then 'removed' else 'retyped' end as change_kind, case when ta is null then '' else field end as field_before, case when tb is null then '' else field end as field_after from c"""
# content of a field: patterns of its values, exactly (the operator keeps 64 hashed bits of them), and its range
_SHAPE = "case when t in ('object', 'array') then json_structure(raw)::varchar when t = 'string' then regexp_replace(regexp_replace(regexp_replace(raw, '[a-z]', 'a', 'g'), '[A-Z]', 'A', 'g'), '[0-9]', '9', 'g') else '' end"
_LIKE = lambda a, b: f"""least(len(list_intersect({a}.shapes, {b}.shapes))::double / len(list_distinct(list_concat({a}.shapes, {b}.shapes))), case when ({a}.lo is null) != ({b}.lo is null) then 0 when {a}.lo is null then 1
    when greatest({a}.hi, {b}.hi) - least({a}.lo, {b}.lo) + u = 0 then 1 else greatest(0, (least({a}.hi, {b}.hi) - greatest({a}.lo, {b}.lo) + u) / (greatest({a}.hi, {b}.hi) - least({a}.lo, {b}.lo) + u)) end)"""  # noqa: E731
SQL["p1_found"] = f"""with {_TYPED},
  x as (select f.feed, f.file_seq as seq, field, t, {_SHAPE} as shape, case when t not in ('object', 'array') then try_cast(raw as double) end as z from w join processed_files f on f.file_path = w.file),
  o as (select feed, seq, field, list(distinct shape) as shapes, min(z) as lo, max(z) as hi from x group by all),
  g as (select x.feed, x.field, s.t, list(distinct shape) as shapes, min(z) as lo, max(z) as hi from x join s on s.feed = x.feed and s.seq = x.seq and s.field = x.field group by all),
  m as (select r.feed, r.seq, r.field as x, a.field as y, case when r.ta = 'number' then 0 else 1 end as u, oa.shapes, oa as oa, ob as ob, ga as ga, gb as gb from c r join c a on a.feed = r.feed and a.seq = r.seq and r.tb is null and a.ta is null and r.ta = a.tb
    join o oa on oa.feed = r.feed and oa.seq = r.seq - 1 and oa.field = r.field join o ob on ob.feed = r.feed and ob.seq = r.seq and ob.field = a.field join g ga on ga.feed = r.feed and ga.field = r.field and ga.t = r.ta join g gb on gb.feed = r.feed and gb.field = a.field and gb.t = a.tb),
  l as (select feed, seq, x, y, greatest({_LIKE("oa", "ob")}, {_LIKE("ga", "gb")}) as alike from m),
  best as (select * from l where alike >= 0.4 qualify row_number() over (partition by feed, seq, x order by alike desc, x, y) = 1 and row_number() over (partition by feed, seq, y order by alike desc, x, y) = 1)
  select feed, seq as file_seq, 'renamed' as change_kind, x as field_before, y as field_after from best
  union all select c.feed, c.seq, case when ta is null then 'added' when tb is null then 'removed' else 'retyped' end, case when ta is null then '' else field end, case when tb is null then '' else field end from c
    where not exists (select 1 from best b where b.feed = c.feed and b.seq = c.seq and (c.tb is null and b.x = c.field or c.ta is null and b.y = c.field))"""
_PARTS = "regexp_extract_all(',' || raw_line, ',(\"(?:[^\"]|\"\")*\"|[^\",]*)', 1)"
_WELL = f"regexp_full_match(raw_line, '{_CELL}(,{_CELL})*')"
_AT = lambda i: f"trim(case when cs[{i}] like '\"%' then replace(substr(cs[{i}], 2, length(cs[{i}]) - 2), '\"\"', '\"') else cs[{i}] end, ' ' || chr(9))"
_BAD = {"D:decimal_or_empty": f"not regexp_full_match({_AT(6)}, '({_NUM})?')", "Score:score": f"not regexp_full_match({_AT(7)}, '({_NUM}|DNS|DNF|SCR|WD)?')", "Rank:rank": f"not regexp_full_match({_AT(8)}, '{_RANK}')"}
_LINES = f"(select raw_id, raw_line, {_WELL} as well, {_PARTS} as cs from raw_results where raw_line != '{_P5_HEADER}')"
_REASONS = f"(select raw_id, cs, case when not well then 'quoting' when len(cs) != 9 then 'cells:' || len(cs) else " + "array_to_string([" + ", ".join(f"case when {c} then '{r}' end" for r, c in _BAD.items()) + f"], ';') end as reasons from {_LINES})"
SQL["p5_reasons"] = f"select raw_id, reasons from {_REASONS} where reasons != ''"
SQL["p5_valid"] = "select raw_id, " + ", ".join(f"nullif({_AT(i)}, '') as \"{c}\"" for i, c in enumerate(badrows.RESULT_LINES.columns, 1)) + f" from {_REASONS} where coalesce(reasons, '') = ''"
_OF = "(select r.result_id, r.level, nullif(a.discipline_id, 99) as discipline_id from results_v2 r left join apparatus a using (apparatus_id))"
_HAS = lambda *on: "exists (select 1 from ref_levels l where " + " and ".join(on) + ")"
_L, _D = "l.level_name = r.level", "l.discipline_id = r.discipline_id"
SQL["p6_composite"] = f"""
  select result_id, 'simple' as ref_column, 'missing' as kind from {_OF} r where level is not null and discipline_id is not null and not {_HAS(_L, _D)}
  union all select result_id, 'partial', 'missing' from {_OF} r where level is not null and discipline_id is not null and not {_HAS(_L, _D)} or level is not null and discipline_id is null and not {_HAS(_L)} or level is null and discipline_id is not null and not {_HAS(_D)}
  union all select result_id, 'full', 'missing' from {_OF} r where (level is null) != (discipline_id is null) or level is not null and discipline_id is not null and not {_HAS(_L, _D)}"""
#: The columns of the unified table over the folder at which SQL is compared, and their fields in order.
_UNIFIED = {
    "f_Born": "Born", "f_Category": "Category", "f_ND double": "ND", "f_SessionLabel": "SessionLabel", "f_Squad": "Squad", "f_bib_no bigint": "bib_no", "f_clip": "clip", "f_coach_id": "coach_id", "f_ctry": "ctry", "f_e_total double": "e_total",
    "f_exec_score double": "exec_score", "f_group_code": "group_code", "f_grp": "grp", "f_is_team": "is_team team_flag", "f_judge_panel bigint": "judge_panel", "f_judges": "e_judges judges", "f_nat": "nat", "f_nd_2": "nd neutral_ded", "f_rep_cat": "rep_cat",
    "f_reporting_category": "reporting_category", "f_rot": "rot", "f_sess bigint": "sess", "f_squad_2 bigint": "squad", "f_sv": "sv", "f_team": "team", "f_video": "video", "f_yob": "yob",
}
_JSON = lambda f: f"json_extract_string(j, '$.{f}')"
_FIELD = lambda c, fs: f"try_cast(coalesce({', '.join(map(_JSON, fs.split()))}, null) as {(c + ' varchar').split()[1]}) as \"{c.split()[0]}\""
SQL["p1_unified"] = f"""select {", ".join(_KEPT)}, {", ".join(_FIELD(c, fs) for c, fs in _UNIFIED.items())}, coalesce(session, {_JSON("session_name")}) as session, 0 as casts_lost
  from (select *, case when json_valid(details_json) then details_json::json end as j from results_v2)"""
