import json

from pyspark.sql import functions as F

from springfloor import config
from springfloor.sources import adapters, files, html


def _lines(spark, named):
    return spark.createDataFrame([(f, i, x) for f, xs in named.items() for i, x in enumerate(xs, 1)], "file string, line_no int, line string")


def _facts(df):
    return {(r.athlete_name, r.apparatus): r for r in df.collect()}


def test_kscore(spark):
    header = "Name,Club,Level,Age Group,Bib #,Raw_Meet_Name,Result_Uneven_Bars_D,Result_Uneven_Bars_Score,Result_Uneven_Bars_Rnk,Result_Physical_Score"
    got = _facts(adapters.kscore(_lines(spark, {"d/kscore_12_FINAL_x.csv": [header, '"Roe, Al",N,P1,U9,7,Cup,3.1,9.1,2,5', "Bo,,P2,,,,9.2,Gold,,", "Cy,X,,,,,,DNS,,", header, "Di,X,,,,,,,,", ",X,,,,,1,2,,", "Ed,X,,,,,9.2,SCR,,"]}), config.COLUMN_ALIASES))
    assert {k[0] for k in got} == {"Roe, Al", "Bo", "Cy", "Ed"} and {k[1] for k in got} == {"Uneven Bars"}
    al, bo, ed = (got[n, "Uneven Bars"] for n in ("Roe, Al", "Bo", "Ed"))
    assert (al.source_meet_id, al.meet_name, al.gender, al.score_final, al.score_d, al.rank_text, al.level, al.age_group) == ("12", "Cup", "F", 9.1, 3.1, "2", "P1", "U9")
    assert json.loads(al.details_json)["bib_num"] == "7"
    assert (bo.score_final, bo.score_text, bo.rank_text) == (9.2, None, "Gold") and (ed.score_final, ed.score_text) == (None, "SCR")


def test_livemeet(spark):
    got = _facts(adapters.livemeet(_lines(spark, {"d/A_FINAL_q.csv": ["title", "Name,Club,Day 1 Flight,Unnamed: 3,Vault,Vault,Vault,Beam,Beam,Beam,Beam", "Al,N,2,z,3.0,9.0,1,2.0,8.0,2,EX", 'Bo,N,,,,,,,"1,008.5",3,'], "d/B_PEREVENT_q.csv": ["Name,Club,Result_Rings_Total,Result_Rings_Score,Result_Rings_SV,Result_AllAround_Score", "Cy,N,12.5,6.5,4.5,40"]}), config.COLUMN_ALIASES))
    assert (got["Al", "Vault"].score_d, got["Al", "Vault"].rank_text, got["Al", "Vault"].session) == (3.0, "1", "2")
    aa = got["Al", "All Around"]
    assert (aa.calculated, aa.score_final, aa.score_d) == (True, 17.0, 5.0) and "unnamed" not in (aa.details_json or "")
    assert got["Bo", "Beam"].score_final == 1008.5 and got["Bo", "All Around"].score_d is None
    cy = got["Cy", "Rings"]
    assert (cy.source_meet_id, cy.gender, cy.score_final, cy.score_d) == ("B", "M", 12.5, 4.5) and (got["Cy", "All Around"].score_d, got["Cy", "All Around"].calculated) == (4.5, False)


def test_mso(spark):
    got = _facts(adapters.mso(_lines(spark, {"m/77_mso.csv": ["Gymnast,Team,Lvl,Meet,VT,UB,AA", "Al,N,XG,Open,1 500 9,250 8,35.5", "Bo,N,XG,Open,T2 100 9 0.5,x y,5 a b c 9.9"], "m/78_mso.csv": ["Name,Team,PH,FLR", "Cy,N,9.1,8"], "m/79_mso.csv": ["who,PH", "Di,9"]}), config.COLUMN_ALIASES))
    assert {(k, r.score_final, r.rank_text, r.bonus) for k, r in got.items() if k[0] in ("Al", "Bo")} == {
        (("Al", "Vault"), 9.5, "1", None), (("Al", "Uneven Bars"), 8.25, None, None), (("Al", "All Around"), 35.5, None, None), (("Bo", "Vault"), 9.1, "T2", 0.5), (("Bo", "All Around"), 9.9, "5", None),
    }
    assert got["Al", "Vault"].gender == "F" and got["Al", "Vault"].source_meet_id == "77" and got["Cy", "Pommel Horse"].gender == "M" and not any(k[0] == "Di" for k in got)


def test_ksis(spark):
    got = _facts(adapters.ksis(_lines(spark, {"k/x.csv": ["MeetID,MeetName,MeetYear,Session,Place,Name,Club,AA_Score,mfloor_Total,mfloor_D,mfloor_E,horse_Total", "9,Cup,2024,MAG 1,3,Al,N,24.1,12.150(5),4.0,8.15,11.9", "9,Cup,2024,WAG,,Bo,N,,,,,"]}), {}))
    floor, aa = got["Al", "Floor"], got["Al", "All Around"]
    assert (floor.score_final, floor.rank_text, floor.score_d, floor.score_e, floor.gender, floor.source_meet_id, floor.meet_year) == (12.15, "5", 4.0, 8.15, "M", "9", "2024")
    assert (aa.score_final, aa.rank_text, aa.level) == (24.1, "3", "MAG 1") and not any(k[0] == "Bo" for k in got)


def test_dispatch_and_empty(spark):
    lines = _lines(spark, {"a/1_FINAL_.csv": ["Name,Result_Vault_Score", "Al,9"], "b.csv": ["x"], "c.csv": ["Name,Club"]}).withColumn("site", F.when(F.col("file") == "b.csv", "huh").when(F.col("file") == "c.csv", "mso").otherwise("kscore"))
    facts, errors = adapters.read_results(lines, F.col("site"))
    assert [(r.athlete_name, r.meet_name) for r in facts.collect()] == [("Al", "Kscore 1")]
    assert {(r.file, r.error) for r in errors.collect()} == {("b.csv", "unknown source huh"), ("c.csv", "no results found")}
    facts, errors = adapters.read_results(lines.limit(0), F.col("site"))
    assert facts.count() == errors.count() == 0


def test_lines_of_split_files(spark, tmp_path):
    rows = [f"line {i} é" for i in range(1, 4001)]
    (tmp_path / "a.csv").write_text("﻿" + "\r\n".join(rows), encoding="utf-8")
    (tmp_path / "b.csv").write_bytes("x\n\nÉlan\n".encode("latin-1"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {(r.file.rsplit("/", 1)[1], r.line_no): r.line for r in files.lines(spark, str(tmp_path), "*.csv").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {**{("a.csv", i): x for i, x in enumerate(rows, 1)}, ("b.csv", 1): "x", ("b.csv", 3): "Élan"}


def test_messy_and_padded(spark):
    rows = files.messy_records(_lines(spark, {"f": ["Results", ",Gymnast,Team,Vault,,,Floor", ",,,D,Score,Rnk,Score", "0,Al,N,3,9,1,8", "1,Bo,,,,,"], "g": ["no header here", "1,2"]}))
    got = {(r.file, r.row): {x.header: x.value for x in r.fields} for r in rows.collect()}
    assert got["f", 4] == {"Gymnast": "Al", "Team": "N", "Result_Vault_D": "3", "Result_Vault_Score": "9", "Result_Vault_Rnk": "1", "Result_Floor_Score": "8"}
    assert got["f", 5]["Team"] is None and ("g", 2) in got
    p = files.padded_rows(_lines(spark, {"m": ["id,name,rest", "1,Cup", "1,Later,x", "2,Open,a,b,c", ",x"]}), ["id", "name", "rest"])
    assert sorted(tuple(r) for r in p.collect()) == [("1", "Cup", None), ("2", "Open", "a,b,c")]


def test_reports(spark):
    t = _lines(spark, {"r": ["--- 1. Gaps ---", "[livemeet] Test Cup (Lvl XG): Missing Floor", "[mso] Other (Lvl 1): Missing", "--- 3. Ghost Entries ---", "0  livemeet  Panther Open   Al Roe", "nothing"]})
    assert {(r.meet_name, r.level, r.ghost) for r in files.report_gaps(t).collect()} == {("Test Cup", "XG", False), ("Panther Open", None, True)}


def test_page_layouts(spark):
    page = (
        "<h3>Vault</h3><div class='resultsTitle'><span class='rpSubTitle'>(Age Group: U9)</span></div><table data-agepartitioncd='P1'><tr><th>Name</th><th>Club</th><th>D-Score</th><th>Final</th><th>Final</th></tr>"
        "<tr><td>Al</td><td>N<table><tr><td>inner</td></tr><tr><td>x</td></tr></table></td><td>3</td><td>9</td><td>9</td></tr><tr><td>short</td></tr></table>"
    )
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    w = html.accumulated(pages, "page_id", "html").collect()
    assert [(r.name, r.club, r.age_group, r.results) for r in w] == [("Al", "N", "U9", {"Result_Vault_D": "3", "Result_Vault_Score": "9"})]
    e = {r.table_no: (r.age_code, r["values"]) for r in html.event_rows(pages, "page_id", "html").collect()}
    assert e[0] == ("P1", {"Name": "Al", "Club": "N", "D-Score": "3", "Final": "9", "Final_1": "9"}) and e[1][1] == {"inner": "x"}
    ksis = "<table><thead><img src='./horse.png'></thead><tbody><tr><td>1</td><td>CAN</td><td>3 - <a>Al Roe</a><br>North</td><td>2010</td><td>12.1</td><td>40</td></tr><td>4</td><td>8.1</td><td></td><td>0.1</td><tr></tr></tbody></table>"
    r = html.two_level_rows(spark.createDataFrame([(1, ksis)], "k int, h string"), "k", "h").first()
    assert (r.place, r.athlete_rank, r.name, r.club, r.year, r.aa_score, r.results) == ("1", "3", "Al Roe", "North", "2010", "40", {"horse_Total": "12.1", "horse_D": "4", "horse_E": "8.1", "horse_Bonus": "", "horse_ND": "0.1"})
    found = html.containers(spark.createDataFrame([('<div data-meetid="5"><h3>Cup</h3></div><div data-meetid="6"><h3>Trampoline Open</h3></div>',)], "h string"), "h")
    assert [(x.meet_id, x.name) for x in found.collect()] == [("5", "Cup")]


def test_lines_meet_headers_where_they_are_read(spark):
    """A few large files: lines are not shuffled by their file, not even without a threshold for broadcasts."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = spark.createDataFrame([("k1.csv", 1, "MeetID,MeetName,Session,Name,Club,wvault_Total"), ("k1.csv", 2, "7,ARTW Cup,N,Ann,X,9.5(2)")], "file string, line_no bigint, line string")
        facts = adapters.ksis(text, {})
        assert "SortMergeJoin" not in facts._jdf.queryExecution().executedPlan().toString()
        assert [(r.source_meet_id, r.athlete_name, r.score_final, r.rank_text) for r in facts.collect()] == [("7", "Ann", 9.5, "2")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
