"""Queries over files and pages: tables of the folder are written in the form of a source,
read back by it, and must give what SQL says of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import dates, text
from ..operators import curation, sinks
from ..runtime import scratch, table
from ..sources import adapters, files, html

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return register


def csv_cell(x: Column) -> Column:
    """A value as a quoted CSV cell, empty for null."""
    return F.when(x.isNull(), "").otherwise(F.concat(F.lit('"'), F.replace(x.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')))


def csv_lines(rows: DataFrame, file: Column, number: Column, header: str, cells: list[Column]) -> DataFrame:
    """(file, line_no, line): rows as CSV lines, numbered from 2, under a header a file."""
    body = rows.select(file.alias("file"), (number + 2).cast("bigint").alias("line_no"), F.concat_ws(",", *[csv_cell(c) for c in cells]).alias("line"))
    return body.unionByName(body.select("file").distinct().select("file", F.lit(1).cast("bigint").alias("line_no"), F.lit(header).alias("line")))


def text_file(spark: SparkSession, values: DataFrame, name: str) -> str:
    """Where the single column ``values`` was written as text."""
    path = scratch(spark, name)
    values.write.text(path)
    return path


def line_files(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Where (file, line_no, line) was written, a folder of one text file for each file."""
    path = scratch(spark, name)
    key = F.replace("file", F.lit("/"), F.lit("~")).alias("file")
    rows.select(key, "line_no", F.col("line").alias("value")).repartition("file").sortWithinPartitions("file", "line_no").drop("line_no").write.partitionBy("file").text(path)
    return path


def original(file: Column) -> Column:
    """The name of a file that ``line_files`` wrote."""
    return F.replace(F.url_decode(F.regexp_extract(file, "/file=([^/]*)/", 1)), F.lit("~"), F.lit("/"))


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_results").select(F.col("file_path").alias("file"), "line_no", F.col("raw_line").alias("line"))


@query("select file_path as file, line_no, raw_line as line from raw_results where raw_line != ''")
def read_lines(spark: SparkSession, d: str) -> DataFrame:
    return files.lines(spark, line_files(spark, _raw(spark, d), "raw")).withColumn("file", original(F.col("file")))


@query("select header, count(*) as files, sum(n)::bigint as rows from (select file_path, arg_min(raw_line, line_no) as header, count(*) - 1 as n from raw_results group by 1) group by 1")
def header_census(spark: SparkSession, d: str) -> DataFrame:
    return files.header_census(files.file_headers(spark, line_files(spark, _raw(spark, d), "raw"), "*.txt"))


@query("select md5(string_agg(raw_line || chr(10), '' order by line_no)) as file_hash, sum(strlen(raw_line) + 1)::bigint as length from raw_results group by file_path")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return files.file_hashes(spark, line_files(spark, _raw(spark, d), "raw"), "*.txt").select("file_hash", "length")


@query("select file_path from raw_results group by 1 having md5(string_agg(raw_line || chr(10), '' order by line_no)) not in (select md5(string_agg(raw_line || chr(10), '' order by line_no)) from raw_results where file_path like '%/kscore/%' group by file_path)")
def unloaded_files(spark: SparkSession, d: str) -> DataFrame:
    hashes = files.file_hashes(spark, line_files(spark, _raw(spark, d), "raw"), "*.txt").withColumn("file", original(F.col("file")))
    done = hashes.filter(F.col("file").contains("/kscore/")).select("file_hash")
    return sinks.unprocessed(hashes, done).select(F.col("file").alias("file_path"))


@query("select file_path as file, line_no, raw_line || ' é' as line from raw_results where raw_line != ''")
def latin_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines in Latin-1: read as such, as they are no UTF-8."""
    path = scratch(spark, "latin")
    rows = _raw(spark, d).select(F.replace("file", F.lit("/"), F.lit("~")).alias("file"), "line_no", F.concat("line", F.lit(" é")).alias("value"))
    rows.repartition("file").sortWithinPartitions("file", "line_no").drop("line_no").write.option("encoding", "ISO-8859-1").partitionBy("file").csv(path, sep="\x01", quote="", escape="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return files.lines(spark, path).withColumn("file", original(F.col("file")))


# --- the four sites ---------------------------------------------------------------------------------
_APPS = config.GOLD_ORDER["F"]
_SCORE = lambda c: f"nullif(trim({c}), '')"
_IS = lambda c: f"coalesce(regexp_full_match(trim(replace({c}, ',', '')), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'), false)"
_NUM = lambda c: f"case when {_IS(c)} then trim(replace({c}, ',', ''))::double end"
_SCRATCH = lambda c: f"coalesce(upper(trim({c})) in ('S', 'DNS', 'SCRATCH', 'SCR', 'WD', 'SC') or upper(trim({c})) like 'SCR%', false)"
_LONG = " union all ".join(f"select gold_id, comp_year, {_SCORE('athlete_name')} as athlete_name, {_SCORE('club')} as club, {_SCORE('meet_name')} as meet_name, {_SCORE('level')} as level, '{n}' as apparatus, {_SCORE(p + '_score')} as s, {_SCORE(p + '_d')} as d, {_SCORE(p + '_rank')} as r from gold_results_wag" for p, n in _APPS)
_SETTLED = f"(select *, case when {_IS('d')} and not {_IS('s')} and not {_SCRATCH('s')} then d else s end as fin from ({_LONG}) where (s is not null or d is not null) and athlete_name is not null)"
_FACT = "source_meet_id, athlete_name, club, gender, apparatus, score_final, score_text, score_d, rank_text, level, calculated"


def _gold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold_results_wag")


def _facts(facts: DataFrame) -> DataFrame:
    return facts.select((F.col("row") - 2).cast("bigint").alias("gold_id"), *_FACT.split(", "))


_KSCORE_HEADER = "Gymnast,Team,Lvl,Raw_Meet_Name," + ",".join(f"Result_{n.replace(' ', '_')}_{x}" for _, n in _APPS for x in ("D", "Score", "Rnk"))


@query(f"select gold_id, 'y' || comp_year as source_meet_id, athlete_name, club, 'F' as gender, apparatus, {_NUM('fin')} as score_final, case when not {_IS('fin')} then fin end as score_text, {_NUM('d')} as score_d, coalesce(r, case when not {_IS('s')} then s end) as rank_text, level, false as calculated from {_SETTLED}")
def kscore_facts(spark: SparkSession, d: str) -> DataFrame:
    g = _gold(spark, d)
    file = F.concat(F.lit("data/kscore_y"), "comp_year", F.lit("_FINAL_WAG.csv"))
    cells = [F.col(c) for c in ("athlete_name", "club", "level", "meet_name")] + [F.col(f"{p}_{x}") for p, _ in _APPS for x in ("d", "score", "rank")]
    return _facts(adapters.kscore(csv_lines(g, file, F.col("gold_id"), _KSCORE_HEADER, cells), config.COLUMN_ALIASES))


_LIVE = f"""(with f as (select * from {_SETTLED}), own as (select gold_id, athlete_name, club, level, comp_year, apparatus, {_NUM("fin")} as score_final, case when not {_IS("fin")} then fin end as score_text, {_NUM("d")} as score_d, r as rank_text, false as calculated from f where apparatus != 'All Around'),
  total as (select gold_id, any_value(athlete_name) as athlete_name, any_value(club) as club, any_value(level) as level, any_value(comp_year) as comp_year, 'All Around' as apparatus, round(sum(score_final), 3) as score_final, null as score_text, case when sum(score_d) > 0 then round(sum(score_d), 3) end as score_d, null as rank_text, true as calculated from own group by gold_id having count(score_final) > 0)
  select * from own union all by name select * from total)"""


@query(f"select gold_id, 'M' || comp_year as source_meet_id, athlete_name, club, 'F' as gender, apparatus, score_final, score_text, score_d, rank_text, level, calculated from {_LIVE}")
def livemeet_facts(spark: SparkSession, d: str) -> DataFrame:
    """Headers that repeat per apparatus, and no all-around: it is summed."""
    g = _gold(spark, d)
    apps = [(p, n) for p, n in _APPS if n != config.ALL_AROUND]
    file = F.concat(F.lit("data/M"), "comp_year", F.lit("_PEREVENT_x.csv"))
    cells = [F.col(c) for c in ("athlete_name", "club", "level")] + [F.col(f"{p}_{x}") for p, _ in apps for x in ("d", "score", "rank")]
    header = "Name,Club,Level," + ",".join(n for _, n in apps for _ in range(3))
    return _facts(adapters.livemeet(csv_lines(g, file, F.col("gold_id"), header, cells), config.COLUMN_ALIASES))


_MSO = " union all ".join(f"""select gold_id, comp_year, {_SCORE("athlete_name")} as athlete_name, {_SCORE("club")} as club, '{n}' as apparatus, case when regexp_full_match(trim({p}_score), '[0-9]+([.][0-9]+)?') then trim({p}_score)::double end as s, {_SCORE(p + "_rank")} as r from gold_results_wag""" for p, n in _APPS)


@query(f"""select gold_id, 'm' || comp_year as source_meet_id, athlete_name, club, 'F' as gender, apparatus, floor(s) + floor(round((s - floor(s)) * 1000)) / 1000 as score_final, coalesce(r || ' ', '') || round((s - floor(s)) * 1000)::int || ' ' || floor(s)::int as score_text, null::double as score_d, r as rank_text, null::varchar as level, false as calculated
  from ({_MSO}) where athlete_name is not null and s is not null and regexp_matches(coalesce(r, '1'), '^[0-9T]+$')""")
def mso_facts(spark: SparkSession, d: str) -> DataFrame:
    """Cells of rank, thousandths and whole points under short headers."""
    g = _gold(spark, d)
    cells = [F.col("athlete_name"), F.col("club")]
    for p, _ in _APPS:
        s = F.when(F.trim(f"{p}_score").rlike(r"^[0-9]+(\.[0-9]+)?$"), F.trim(f"{p}_score").try_cast("double"))
        rank = F.nullif(F.trim(f"{p}_rank"), F.lit(""))
        fine = F.coalesce(rank, F.lit("1")).rlike("^[0-9T]+$")
        cells.append(F.when(fine & s.isNotNull(), F.concat_ws(" ", rank, F.round((s - F.floor(s)) * 1000).cast("int"), F.floor(s).cast("int"))))
    file = F.concat(F.lit("data/m"), "comp_year", F.lit("_mso.csv"))
    return _facts(adapters.mso(csv_lines(g, file, F.col("gold_id"), "Gymnast,Team,VT,UB,BB,FX,AA", cells), config.COLUMN_ALIASES))


_KSIS = {"wvault": "vt", "ubars": "ub", "beam": "bb", "wfloor": "fx"}
_KSIS_ROWS = " union all ".join(f"""select gold_id, comp_year, {_SCORE("athlete_name")} as athlete_name, {_SCORE("club")} as club, {_SCORE("level")} as level, '{config.KSIS_APPARATUS[c]}' as apparatus, {_SCORE(p + "_score")} as s, {_SCORE(p + "_d")} as d, case when regexp_matches({p}_score, '^[0-9.]+$') then nullif(regexp_extract({p}_rank, '^[0-9]+$'), '') end as r from gold_results_wag""" for c, p in _KSIS.items())


@query(f"""select gold_id, 'k' || comp_year as source_meet_id, athlete_name, club, 'F' as gender, apparatus, {_NUM("s")} as score_final, case when not {_IS("s")} then s end as score_text, {_NUM("d")} as score_d, r as rank_text, level, false as calculated from ({_KSIS_ROWS}) where athlete_name is not null and (s is not null or {_NUM("d")} is not null)
  union all select gold_id, 'k' || comp_year, {_SCORE("athlete_name")}, {_SCORE("club")}, 'F', 'All Around', {_NUM(_SCORE("aa_score"))}, case when not {_IS(_SCORE("aa_score"))} then {_SCORE("aa_score")} end, null, {_SCORE("aa_rank")}, {_SCORE("level")}, false from gold_results_wag where {_SCORE("athlete_name")} is not null and {_SCORE("aa_score")} is not null""")
def ksis_facts(spark: SparkSession, d: str) -> DataFrame:
    """Columns by code, ranks in brackets after the totals; the meet's name tells the discipline."""
    g = _gold(spark, d)
    cells = [F.concat(F.lit("k"), "comp_year"), F.lit("ARTW Cup"), F.col("level"), F.col("aa_rank"), F.col("athlete_name"), F.col("club"), F.col("aa_score")]
    for p in _KSIS.values():
        ranked = F.col(f"{p}_score").rlike("^[0-9.]+$") & F.col(f"{p}_rank").rlike("^[0-9]+$")
        cells += [F.when(ranked, F.concat(F.col(f"{p}_score"), F.lit("("), f"{p}_rank", F.lit(")"))).otherwise(F.col(f"{p}_score")), F.col(f"{p}_d")]
    header = "MeetID,MeetName,Session,Place,Name,Club,AA_Score," + ",".join(f"{c}_{x}" for c in _KSIS for x in ("Total", "D"))
    return _facts(adapters.ksis(csv_lines(g, F.concat(F.lit("data/k"), "comp_year", F.lit(".csv")), F.col("gold_id"), header, cells), config.COLUMN_ALIASES))


_NAME = "regexp_extract(file_path, '([^/]*)$', 1)"
_FILE_ID = f"case source when 'kscore' then regexp_replace(split_part({_NAME}, '_FINAL_', 1), '^kscore_', '') when 'livemeet' then split_part(split_part(split_part({_NAME}, '_FINAL_', 1), '_PEREVENT_', 1), '_BYEVENT_', 1) when 'mso' then split_part({_NAME}, '_mso.csv', 1) else '77' end"


@query(f"""with p as (select *, {_FILE_ID} as id from processed_files), m as (select source_meet_id as id, min(name) as name from meets group by 1)
  select file_path as file, source, case source when 'ksis' then 9.1 when 'mso' then 9.3 else 9.2 end as score_final, coalesce(m.name, case when source = 'kscore' then 'Kscore ' || p.id end) as meet_name, null as error from p left join m using (id) where file_seq % 3 != 0 and source in ('kscore', 'livemeet', 'mso', 'ksis')
  union all select file_path, null, null, null, case when file_seq % 3 = 0 then 'unknown source x' || source else 'no results found' end from p where file_seq % 3 = 0 or source not in ('kscore', 'livemeet', 'mso', 'ksis')""")
def dispatched_files(spark: SparkSession, d: str) -> DataFrame:
    """Files of all sites and of unknown ones in one pass, meets named by the manifest."""
    p = table(spark, d, "processed_files").withColumn("site", F.when(F.col("file_seq") % 3 == 0, F.concat(F.lit("x"), "source")).otherwise(F.col("source")))
    line = "MeetID,Name,Club,Session,vault_Total,Result_Vault_Score,VT"
    rows = p.select(F.col("file_path").alias("file"), F.explode(F.array(F.struct(F.lit(1).alias("line_no"), F.lit(line).alias("line")), F.struct(F.lit(2).alias("line_no"), F.lit("77,Alpha Roe,N,,9.1,9.2,9.3").alias("line")))).alias("x"), "site").select("file", "x.*", "site")
    m = table(spark, d, "meets").select(F.col("source_meet_id").alias("meet_id"), "name", F.col("comp_year").cast("string").alias("year"))
    facts, errors = adapters.read_results(rows, F.col("site"), m)
    facts = facts.filter("not calculated")
    return facts.select("file", "source", "score_final", "meet_name", F.lit(None).cast("string").alias("error")).unionByName(errors, allowMissingColumns=True)


@query("select file_path, sum(case when not regexp_matches(raw_line, '^MeetID,Athlete,') then 1 else 0 end)::bigint as n from raw_results where raw_line not like '%\"%' group by 1 having n > 0")
def messy_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows below the header, wherever it stands among the leading lines. Lines with quotes are
    left to problem 5; repeated headers are none."""
    rows = files.messy_records(_raw(spark, d).filter(~F.col("line").contains('"')))
    header = F.exists("fields", lambda x: (x["header"] == "Athlete") & (F.coalesce(x["value"], F.lit("")) == "Athlete"))
    return rows.filter(~header).groupBy(F.col("file").alias("file_path")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""select 'd/' || comp_year || '_FINAL_x.csv' as file, gold_id, {_SCORE("athlete_name")} as "Name", {_SCORE("club")} as "Club", {_SCORE("vt_d")} as vt_d, {_SCORE("vt_score")} as vt_score, {_SCORE("vt_rank")} as vt_rank, {_SCORE("fx_score")} as fx_score from gold_results_wag""")
def two_row_files(spark: SparkSession, d: str) -> DataFrame:
    """A title line, a header of two rows with an index column, columns renamed, and the name
    of the file made final."""
    g = _gold(spark, d)
    cells = [F.col("gold_id").cast("string"), F.col("athlete_name"), F.col("club"), F.col("vt_d"), F.col("vt_score"), F.col("vt_rank"), F.col("fx_score")]
    body = csv_lines(g, F.concat(F.lit("d/"), "comp_year", F.lit("_ksis_x.csv")), F.col("gold_id") + 1, ",Gymnast,Team,Vault,,,Floor", cells)
    below = body.filter("line_no = 1")
    rows = body.filter("line_no > 1").unionByName(below.withColumn("line_no", F.lit(2).cast("bigint"))).unionByName(below.withColumns({"line_no": F.lit(1).cast("bigint"), "line": F.lit("Results of the day")})).unionByName(below.withColumns({"line_no": F.lit(3).cast("bigint"), "line": F.lit(",,,D,Score,Rnk,Score")}))
    r = files.renamed_fields(files.messy_records(rows.withColumn("line_no", F.when(F.col("line_no") > 3, F.col("line_no") + 10).otherwise(F.col("line_no")))), {"Gymnast": "Name", "Team": "Club", "Born": "Year"}, "_ksis_", "_FINAL_")
    at = lambda h: adapters.field(F.col("fields"), h, exact=True)
    return r.select("file", (F.col("row") - 13).cast("bigint").alias("gold_id"), at("Name").alias("Name"), at("Club").alias("Club"), at("Result_Vault_D").alias("vt_d"), at("Result_Vault_Score").alias("vt_score"), at("Result_Vault_Rnk").alias("vt_rank"), at("Result_Floor_Score").alias("fx_score"))


# --- manifests, aliases, logs, dumps ----------------------------------------------------------------
@query("select source_meet_id as meet_id, nullif(trim(name), '') as name, nullif(trim(start_date_iso), '') as start_date_iso, nullif(trim(location), '') as location, comp_year::varchar as year from meets")
def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meets")
    cells = [F.col("source_meet_id"), F.col("name"), F.col("start_date_iso"), F.col("location"), F.concat("comp_year", F.lit(".0"))]
    return files.manifest(spark, line_files(spark, csv_lines(m, F.lit("ids.csv"), F.col("meet_db_id"), "MeetID,MeetName,start_date_iso,Location,Year", cells), "manifest"))


@query("select source_meet_id as id, name, coalesce(location, '') || case when comp_year is null then '' else ',' || comp_year end as rest from (select *, row_number() over (partition by source_meet_id order by meet_db_id) as n from meets where name is not null and location is not null) where n = 1")
def repaired_manifest(spark: SparkSession, d: str) -> DataFrame:
    """Ragged lines as three columns, what is beyond them in the last, the first row of an id kept."""
    m = table(spark, d, "meets").filter("name is not null and location is not null")
    rows = m.select(F.lit("m.csv").alias("file"), (F.col("meet_db_id") + 1).alias("line_no"), F.concat_ws(",", "source_meet_id", "name", "location", F.col("comp_year").cast("string")).alias("line"))
    return files.padded_rows(rows.filter(~F.col("line").contains('"')), ["id", "name", "rest"])


@query("select * from (values " + ", ".join(f"('{a}', '{c}', {i})" for i, (a, c) in enumerate(config.LEVELS.items())) + ") t(alias, canonical, pos)")
def alias_file(spark: SparkSession, d: str) -> DataFrame:
    import json

    return files.aliases(spark, text_file(spark, spark.createDataFrame([(json.dumps(config.LEVELS),)], "value string").coalesce(1), "aliases"))


@query("""with f as (select source_meet_id as id, count(*) as n from meets join results_v2 using (meet_db_id) where score_final is null group by 1),
  m as (select source_meet_id as id, min(source) as source, min(name) as name from meets where source != 'mso' group by 1)
  select f.id as meet_id, n as fails, coalesce(m.source, case when length(f.id) = 32 then 'livemeet' when starts_with(f.id, 'kscore_') then 'kscore' else 'Unknown' end) as kind, replace(coalesce(m.name, 'Unknown Meet'), '|', '-') as name,
  case coalesce(m.source, case when length(f.id) = 32 then 'livemeet' when starts_with(f.id, 'kscore_') then 'kscore' end) when 'kscore' then 'results/' || replace(f.id, 'kscore_', '') when 'livemeet' then 'MeetResults?Id=' || f.id when 'mso' then 'Results/' || f.id when 'ksis' then 'resultx.php?id_prop=' || f.id else 'Unknown URL' end as page
  from f left join m on m.id = f.id order by n desc, meet_id limit 50""")
def failure_report(spark: SparkSession, d: str) -> DataFrame:
    """The fifty meets that fail most in a log, with what the manifests know of them."""
    m = table(spark, d, "meets")
    log = m.join(table(spark, d, "results_v2").filter("score_final is null").select("meet_db_id"), "meet_db_id").select(F.concat(F.lit("12:00 [FAIL] "), "source_meet_id", F.lit(": timeout")).alias("value"))
    fails = files.failures(spark, text_file(spark, log, "log"))
    return curation.failure_report(fails, m.filter("source != 'mso'").select(F.col("source_meet_id").alias("meet_id"), "name", F.col("source").alias("kind")))


@query("select c_custkey::varchar as k, trim(c_name) as name, c_mktsegment as segment from customer")
def dump_round_trip(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return files.dumped_rows(spark, text_file(spark, sinks.insert_statements(c, "customer", ("c_custkey",)), "dump"), ["k", "name", "segment"])


@query("select source, source_meet_id as meet_id, 'DONE' as status, 0 as fail_count from meets where source_meet_id is not null and comp_year % 2 = 0 union all select source, source_meet_id, 'RETRYING', 3 from meets where source_meet_id is not null and comp_year % 2 = 1")
def status_rows(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "meets").filter("comp_year is not null")
    value = F.when(F.col("comp_year") % 2 == 0, F.lit('"DONE"')).otherwise(F.lit('{"status": "RETRYING", "fail_count": 3}'))
    line = F.concat(F.lit('{"'), "source", F.lit("_"), "source_meet_id", F.lit('": '), value, F.lit("}"))
    return files.status(spark, text_file(spark, m.select(line.alias("value")), "status"), wholetext=False)


@query("select distinct trim(name) as name from clubs")
def target_names(spark: SparkSession, d: str) -> DataFrame:
    return files.targets(spark, text_file(spark, table(spark, d, "clubs").select(F.concat(F.lit("  "), "name").alias("value")), "targets"))


def _gap_report(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an audit report over meets: gaps of levels, then the section of ghosts."""
    m = table(spark, d, "meets").filter("source = 'livemeet' and name is not null").select("meet_db_id", F.nullif(F.trim("name"), F.lit("")).alias("meet_name"))
    r = table(spark, d, "results_v2")
    gaps = r.filter("score_d is null and trim(coalesce(level, '')) != ''").join(m, "meet_db_id").select("meet_name", F.trim("level").alias("level")).distinct()
    a = r.join(table(spark, d, "apparatus").select("apparatus_id", F.col("name").alias("apparatus")), "apparatus_id").groupBy("meet_db_id", "athlete_id").agg(F.min((F.col("apparatus") == config.ALL_AROUND).cast("int")).alias("only"))
    ghosts = a.filter("only = 1").join(m, "meet_db_id").select("meet_name").distinct()
    one = lambda n, x: spark.createDataFrame([(n, x)], "line_no bigint, line string")
    gap_lines = gaps.select((F.lit(10) + F.monotonically_increasing_id() % 1000).alias("line_no"), F.concat(F.lit("[livemeet] "), "meet_name", F.lit(" (Lvl "), "level", F.lit("): Missing Floor")).alias("line"))
    ghost_lines = ghosts.select(F.lit(5000).cast("bigint").alias("line_no"), F.concat(F.lit("0  livemeet  "), "meet_name", F.lit("   Alpha Roe")).alias("line"))
    return one(1, "--- 1. Missing ---").unionByName(gap_lines).unionByName(one(4000, "--- 3. Ghost Entries ---")).unionByName(ghost_lines).withColumn("file", F.lit("audit.txt"))


@query("""with g as (select meet_db_id, source_meet_id, trim(name) as n from meets where source = 'livemeet' and trim(coalesce(name, '')) != ''),
  ids as (select n, min(source_meet_id) as id from g group by 1), a as (select r.meet_db_id, athlete_id, min((a.name = 'All Around')::int) as only_aa from results_v2 r join apparatus a using (apparatus_id) group by 1, 2),
  full_ as (select distinct id from a join g using (meet_db_id) join ids using (n) where only_aa = 1), gap as (select distinct id, trim(level) as level from results_v2 join g using (meet_db_id) join ids using (n) where score_d is null and trim(coalesce(level, '')) != '')
  select id as meet_id, 'full' as kind, 'Ghost Entries' as reason, null as levels from full_ union all select id, 'targeted', 'Missing Apparatus', string_agg(level, '|' order by level) from gap where id not in (select id from full_) group by 1""")
def remediation_queue(spark: SparkSession, d: str) -> DataFrame:
    """Meets to be fetched again, wholly or some levels of them, from an audit's text."""
    ids = table(spark, d, "meets").filter("source = 'livemeet'").select(F.trim("name").alias("name"), F.col("source_meet_id").alias("meet_id"))
    q = curation.remediation(files.report_gaps(_gap_report(spark, d)), ids)
    return q.select("meet_id", "kind", "reason", F.array_join("levels", "|").alias("levels"))


# --- pages ------------------------------------------------------------------------------------------
_safe = lambda c: F.coalesce(F.trim(F.regexp_replace(F.col(c).cast("string"), r"\s+", " ")), F.lit(""))
_clean = lambda c: f"coalesce(trim(regexp_replace({c}::varchar, '\\s+', ' ', 'g')), '')"
_escaped = lambda x: F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
_td = lambda x: F.concat(F.lit("<td>"), _escaped(x), F.lit("</td>"))


def _pages(spark: SparkSession, d: str, body: Column) -> DataFrame:
    return _gold(spark, d).select("gold_id", body.alias("html"))


@query(f"select gold_id, {_clean('level')} as title, header, value from (" + " union all ".join(f"select gold_id, level, '{h}' as header, {_clean(c)} as value from gold_results_wag" for h, c in (("Name", "athlete_name"), ("Vault", "vt_score"), ("Club", "club"))) + ")")
def page_cells(spark: SparkSession, d: str) -> DataFrame:
    head = "</h3><table><tr><th>Name</th><th><img alt='Vault' src='v.png'></th><th style='display: none'>x</th><th>Club</th></tr><tr>"
    body = F.concat(F.lit("<h3>"), _escaped(_safe("level")), F.lit(head), _td(_safe("athlete_name")), _td(_safe("vt_score")), F.lit("<td style='display:none'>7</td>"), _td(_safe("club")), F.lit("</tr><tr><td>short</td></tr></table>"))
    return html.html_cells(_pages(spark, d, body), "gold_id", "html").select("gold_id", "title", "header", "value")


@query(f"select gold_id, {_clean('athlete_name')} as name, {_clean('club')} as club, {_clean('vt_rank')} as place, {_clean('aa_score')} as aa_score, {_clean('vt_score')} as vault, {_clean('vt_d')} as vault_d, {_clean('bb_score')} as beam, {_clean('bb_d')} as beam_d from gold_results_wag where {_clean('athlete_name')} != '' and {_clean('club')} != ''")
def two_level_pages(spark: SparkSession, d: str) -> DataFrame:
    cells = F.concat(_td(_safe("vt_rank")), F.lit("<td>CAN</td><td>3 - <a href='#'>"), _escaped(_safe("athlete_name")), F.lit("</a><br>"), _escaped(_safe("club")), F.lit("</td><td>2010</td>"), _td(_safe("vt_score")), _td(_safe("bb_score")), _td(_safe("aa_score")))
    loose = F.concat(_td(_safe("vt_d")), F.lit("<td>e</td><td></td><td></td>"), _td(_safe("bb_d")), F.lit("<td>e</td><td></td><td></td>"))
    body = F.concat(F.lit("<table><thead><img src='./wvault.png'><img src='./beam.png'></thead><tbody><tr>"), cells, F.lit("</tr>"), loose, F.lit("<tr></tr></tbody></table>"))
    x = html.two_level_rows(_pages(spark, d, body), "gold_id", "html").filter("name != '' and club != ''")
    at = lambda k: F.col("results")[k]
    return x.select("gold_id", "name", "club", "place", "aa_score", at("wvault_Total").alias("vault"), at("wvault_D").alias("vault_d"), at("beam_Total").alias("beam"), at("beam_D").alias("beam_d"))


@query(" union all ".join(f"select gold_id, {_clean('athlete_name')} as name, {_clean('club')} as club, coalesce(nullif({_clean('age')}, ''), 'N/A') as age_group, 'Result_{n.replace(' ', '_')}_{k}' as \"column\", {_clean(p + '_' + x)} as value from gold_results_wag where lower({_clean('athlete_name')}) not in ('', 'nan') and {_clean(p + '_' + x)} != ''" for p, n in _APPS for k, x in (("D", "d"), ("Score", "score"), ("Rnk", "rank"))))
def age_group_pages(spark: SparkSession, d: str) -> DataFrame:
    """A table an apparatus, the age group in the subtitle, put together by athlete."""
    body = [F.lit("<div class='resultsTitle'><span class='rpSubTitle'>(Age Group: "), _escaped(_safe("age")), F.lit(")</span></div>")]
    for p, n in _APPS:
        body += [F.lit(f"<h3>{n}</h3><table><tr><th>Athlete</th><th>Club</th><th>D-Score</th><th>Final</th><th>Rank</th></tr><tr>"), _td(_safe("athlete_name")), _td(_safe("club")), *[_td(_safe(f"{p}_{x}")) for x in ("d", "score", "rank")], F.lit("</tr></table>")]
    wide = html.accumulated(_pages(spark, d, F.concat(*body)), "gold_id", "html")
    return wide.select("gold_id", "name", "club", "age_group", F.explode("results").alias("column", "value"))


@query(f"select gold_id, coalesce(nullif({_clean('level')}, ''), null) as age_code, {_clean('athlete_name')} as name, {_clean('vt_score')} as score, {_clean('vt_rank')} as rank, {_clean('ub_score')} as score_1, {_clean('ub_rank')} as rank_1 from gold_results_wag")
def event_pages(spark: SparkSession, d: str) -> DataFrame:
    """Tables of a view by event: repeated headers numbered, the age partition from the table."""
    code = F.replace(_escaped(_safe("level")), F.lit("'"), F.lit("&#39;"))
    body = F.concat(F.lit("<table data-agepartitioncd='"), code, F.lit("'><tr><th>Name</th><th>Score</th><th>Rank</th><th>Score</th><th>Rank</th></tr><tr>"), *[_td(_safe(c)) for c in ("athlete_name", "vt_score", "vt_rank", "ub_score", "ub_rank")], F.lit("</tr></table>"))
    x = html.event_rows(_pages(spark, d, body), "gold_id", "html")
    return x.select("gold_id", "age_code", *[F.col("values")[h].alias(n) for h, n in (("Name", "name"), ("Score", "score"), ("Rank", "rank"), ("Score_1", "score_1"), ("Rank_1", "rank_1"))])


@query(f"select source_meet_id as meet_id, nullif(trim({_clean('location')}), '') as state, nullif({_clean('name')}, '') as name, nullif({_clean('start_date_iso')}, '') as dates from meets where not ({' or '.join(f'''regexp_matches(lower(coalesce(name, '')), '{p}')''' for p in config.OTHER_SPORT)}) and meet_db_id % 7 != 0")
def discovered_meets(spark: SparkSession, d: str) -> DataFrame:
    """Containers of a discovery page; every seventh meet is given another sport's name."""
    m = table(spark, d, "meets")
    name = F.when(F.col("meet_db_id") % 7 == 0, F.concat(F.lit("Trampoline "), _safe("name"))).otherwise(_safe("name"))
    page = F.concat(F.lit('<html><div data-meetid="'), "source_meet_id", F.lit('" data-state="'), _safe("location"), F.lit('" data-filter-by="x"><h3>'), name, F.lit('</h3><p class="meet-dates">'), _safe("start_date_iso"), F.lit("</p></div>"))
    return html.containers(m.select(page.alias("page")), "page").select("meet_id", "state", "name", "dates")


@query("select l_orderkey::varchar as meet_id, min(l_partkey) as page_id, arg_min(y, l_partkey) as year from (select l_orderkey, l_partkey, strftime(l_shipdate, '%Y') as d, case when year(l_shipdate) >= 2000 then strftime(l_shipdate, '%Y') end as y from lineitem) group by 1")
def linked_meets(spark: SparkSession, d: str) -> DataFrame:
    """Links of listing pages, the first page that names an id, and the year beside it."""
    page = F.concat(F.lit("<table><tr><td><a href='x?id_prop="), F.col("l_orderkey").cast("string"), F.lit("'>m</a></td><td>"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("</td></tr></table>"))
    return html.links(table(spark, d, "lineitem").select(F.col("l_partkey").alias("page_id"), page.alias("html")), "page_id", "html")


@query("select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def date_heads(spark: SparkSession, d: str) -> DataFrame:
    """The first day of ranges like ``Mar 3 – 5`` with the year apart, and manifests' dates."""
    o = table(spark, d, "orders")
    day = F.col("o_orderdate").cast("date")
    span = F.concat(F.date_format(day, "MMM d"), F.element_at(F.array(F.lit(" – "), F.lit(" - "), F.lit(" & ")), (F.col("o_orderkey") % 3 + 1).cast("int")), F.lit("30"))
    year = F.year(day).cast("string")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, dates.range_head(span, year)).otherwise(dates.manifest_date(F.lit(None).cast("string"), F.date_format(day, "dd.MM.yyyy"), year)).cast("string").alias("day"))


@query("select l_orderkey, l_linenumber, l_quantity::int || '.' || l_linenumber as score, l_suppkey::varchar as rank, 'a_b_' || l_suppkey || '.csv' as file from lineitem")
def bracketed_cells(spark: SparkSession, d: str) -> DataFrame:
    """Scores with the rank in brackets, and file names made safe."""
    score = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))
    c = text.ksis_cell(F.concat(score, F.lit("("), F.col("l_suppkey").cast("string"), F.lit(")")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", c["score"].alias("score"), c["rank"].alias("rank"), text.safe_file_name(F.concat(F.lit("a/b: "), F.col("l_suppkey").cast("string"), F.lit(".csv"))).alias("file"))
