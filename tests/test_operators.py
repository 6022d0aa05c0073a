import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from springfloor.operators import order, reshape, resolve, sinks, star
from springfloor.plans import catalogue, upkeep
from springfloor.sources import files, html
from springfloor.streaming import intake

SCORES = ["fx_score", "ph_score", "sr_score", "vt_score", "pb_score", "hb_score", "aa_score"]


def _rows(spark, rows):
    schema = "id bigint, athlete_name string, meet_date string, level string, meet_name string, " + ", ".join(f"{c} string" for c in SCORES)
    return spark.createDataFrame(rows, schema)


def test_similar_rows_fixture(spark):
    rows = [
        (1, "A", "d", "P3", "m", "9.0", "8.0", "7.0", "9.5", "8.5", "7.5", "49.5"), (2, "A", "d", "P3", "m", "9.1", "8.1", "7.1", "9.6", "8.6", "7.6", "49.503"), (3, "A", "d", "P3", "m", "9.0", "1.0", "7.0", "9.5", "8.5", "7.5", "42.5"),
        (4, "A", "d", "P3", "m", "5.0", "5.1", "5.2", "5.3", "5.4", "5.5", "31.5"), (5, "A", "d", "P3", "m", "9.0", None, None, None, None, None, None), (6, None, None, None, "m", None, None, None, None, None, None, None),
    ]
    # a row without any score repeats nothing
    assert sorted(r.id for r in star.similar_rows_kept(_rows(spark, rows), "id", SCORES, "aa_score").collect()) == [1, 4, 5, 6]


def brute_similar(rows):
    there = lambda s: s is not None and s.strip() != ""

    def num(s):
        try:
            return float(s)
        except (TypeError, ValueError):
            return None

    def repeats(k, x):
        ka, xa = num(k[-1]), num(x[-1])
        if ka and xa and abs(ka - xa) < 0.005:
            return True
        m = t = 0
        for a, b in zip(k[5:], x[5:]):
            if there(a) or there(b):
                t += 1
                p, q = num(a), num(b)
                m += abs(p - q) < 0.005 if p is not None and q is not None else a == b
        return t > 0 and (m / t >= 0.8 or m >= 4 and m >= t - 2)

    kept_ids, groups = [], {}
    for r in rows:
        groups.setdefault((r[1], r[2]), []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (-sum(there(s) for s in r[5:]), (r[3] or "").strip().lower() in ("", "nan", "none"), "(Combined)" in r[4], r[0]))
        kept = []
        for r in g:
            if not any(repeats(k, r) for k in kept):
                kept.append(r)
        kept_ids += [r[0] for r in kept]
    return sorted(kept_ids)


def test_similar_rows_against_brute_force(spark):
    rng = random.Random(7)
    score = lambda: rng.choice(["9.0", "9.001", "8.5", "DNS", "", None, " 9.0", "7"])
    rows = [(i, rng.choice("AB"), rng.choice(["d", "e"]), rng.choice(["P3", "nan", None]), rng.choice(["m", "m (Combined)"]), *[score() for _ in SCORES]) for i in range(160)]
    assert sorted(r.id for r in star.similar_rows_kept(_rows(spark, rows), "id", SCORES, "aa_score").collect()) == brute_similar(rows)


def test_rank_propagation(spark):
    rows = [(1, "A", "d1", "P3", "4T"), (2, "A", "d1", "P3", None), (3, "A", "d1", "nan", ""), (4, "A", None, "P3", None)]
    df = spark.createDataFrame(rows, "id int, athlete_name string, meet_date string, level string, r string")
    assert {x.id: x.r for x in star.propagate_ranks(df, ["r"]).collect()} == {1: "4T", 2: "4", 3: "4", 4: None}


def test_unify_and_repoint(spark):
    meets = spark.createDataFrame([(1, "Test Cup", 2024), (2, " test cup ", None), (3, "Test Cup", 2025), (4, "Unnamed: 1", 2024), (5, "Test Cup 2024", None), (6, "test cup", 2024)], "id bigint, name string, year int")
    mapping = resolve.unified(meets, "id", "name", "year")
    assert {r.id: r.canonical for r in mapping.collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 1}
    facts = spark.createDataFrame([(6,), (3,), (None,), (77,)], "m bigint")
    assert sorted(str(r.m) for r in resolve.repointed(facts, "m", mapping, "id").collect()) == ["1", "3", "77", "None"]


def test_peers_null_safe(spark):
    rows = spark.createDataFrame([(1, "Open", "P3", None, True), (2, "Open", "P3", None, False), (3, "Open", "P3", "12", False), (4, "Open", None, None, False)], "id int, m string, l string, a string, chosen boolean")
    assert sorted(r.id for r in star.peers(rows, rows.filter("chosen"), ["m", "l", "a"]).collect()) == [1, 2]


@pytest.mark.parametrize(("combined", "agrees"), [("101.05", True), ("101.2", False), (None, None)])
def test_multi_day(spark, combined, agrees):
    rows = [("A", "d", "P3", "Cup (Day 1)", "50.0"), ("A", "d", "P3", "Cup (Day 2)", "51.0"), ("A", "d", "P3", "Cup", combined)]
    got = star.multi_day_totals(spark.createDataFrame(rows, "athlete_name string, meet_date string, level string, meet_name string, aa_score string")).collect()
    assert [r.agrees for r in got] == ([] if agrees is None else [agrees])


def test_aliases_in_order(spark):
    a = spark.createDataFrame([("P1", "Provincial 1", 0), ("p 1", "Other", 1), ("B1A", "P1A", 2), ("B1A", "later", 3)], "alias string, canonical string, pos int")
    df = spark.createDataFrame([("P1",), ("p1",), ("B1A",), (" x ",), (None,)], "level string")
    assert [r.level for r in resolve.through_aliases(df, "level", a, any_case=True).collect()].count("Provincial 1") == 2
    assert {"P1A", "x", None} <= {r.level for r in resolve.through_aliases(df, "level", a).collect()}


def test_healing_prefers_exact_then_prefixed_then_longest_prefix(spark):
    rows = spark.createDataFrame([("a1", None), ("b1", None), ("longkey_x", None), ("a1b", "kept")], "k string, c string")
    src = spark.createDataFrame([("a1", "exact"), ("s_b1", "prefixed"), ("long", "short"), ("longkey", "longest")], "k string, c string")
    assert {r.k: r.c for r in resolve.healed(rows, "k", src, "k", {"c": "c"}, "s_").collect()} == {"a1": "exact", "b1": "prefixed", "longkey_x": "longest", "a1b": "kept"}


def test_upgrade_and_overlay(spark):
    rows = spark.createDataFrame([(1, None, '{"a":"1"}', 0), (1, 5.0, '{"a":"2","b":"3"}', 1), (2, 1.0, None, 0)], "k int, s double, bag string, o int")
    got = {r.k: (r.s, json.loads(r.bag) if r.bag else None) for r in resolve.upgraded(rows, ["k"], [F.col("o")], "bag").collect()}
    assert got == {1: (5.0, {"a": "1", "b": "3"}), 2: (1.0, None)}
    manual = spark.createDataFrame([(2, 9.0)], "k int, s double")
    assert sorted((r.k, r.s or 0) for r in resolve.overlaid(rows.select("k", "s"), manual, ["k"]).collect()) == [(1, 0), (1, 5.0), (2, 9.0)]


def test_settled_scores(spark):
    rows = [("9.1", "5.0", "1"), ("Gold", "9.5", None), (None, "9.5", "3"), ("DNS", "9.5", None), ("Silver", None, None)]
    wide = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, Result_Balance_Beam_Score string, Result_Balance_Beam_D string, Result_Balance_Beam_Rnk string")
    got = [(r.score_final, r.score_text, r.score_d, r.rank_text) for r in reshape.settled_scores(reshape.unpivot_results(wide, ["i"])).orderBy("i").collect()]
    assert got == [(9.1, None, 5.0, "1"), (9.5, None, 9.5, "Gold"), (9.5, None, 9.5, "3"), (None, "DNS", 9.5, "DNS"), (None, "Silver", None, "Silver")]


def test_folding(spark):
    df = spark.createDataFrame([(1, "x", '{"a":"1"}'), (2, None, "not json"), (3, None, None)], "id int, a string, bag string")
    got = {r.id: json.loads(r.bag) if r.bag else None for r in reshape.folded(df, ["id"], "bag").collect()}
    assert got == {1: {"a": "x"}, 2: {"raw": "not json"}, 3: None}


def test_sources(spark, tmp_path):
    f = tmp_path / "k1_FINAL_1.csv"
    f.write_text('﻿title line\nName,Club,Level,Result_Vault_D,Result_Vault_Score\n"Roe, Alpha",North,P1,10.0,9.1\nName,Club,Level,Result_Vault_D,Result_Vault_Score\nBeta,,P2,,DNS,extra\n', encoding="utf-8")
    w = {r.Name: r for r in files.wide_csv(spark, str(tmp_path), "*.csv").collect()}
    assert set(w) == {"Roe, Alpha", "Beta"} and w["Beta"].Club is None and w["Roe, Alpha"]["Result_Vault_Score"] == "9.1"
    assert [(r.files, r.rows) for r in files.header_census(files.file_headers(spark, str(tmp_path), "*.csv")).collect()] == [(1, 4)]
    assert files.file_hashes(spark, str(tmp_path), "*.csv").count() == 1
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "ids.csv").write_text("Source,MeetID,MeetName,Dates,start_date_iso,Location,Year\nk,k1,Cup,x,2024-01-02,Calgary,2024.0\n")
    r = files.manifest(spark, str(tmp_path / "m")).first()
    assert (r.meet_id, r.name, r.start_date_iso, r.location, r.year) == ("k1", "Cup", "2024-01-02", "Calgary", "2024")
    (tmp_path / "a.json").write_text('{"B": "x", "A": "y"}')
    assert [(r.alias, r.pos) for r in files.aliases(spark, str(tmp_path / "a.json")).orderBy("pos").collect()] == [("B", 0), ("A", 1)]
    assert files.aliases(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "s.json").write_text('{"kscore_k_1": "DONE", "mso_2": {"status": "RETRYING", "fail_count": 3}}')
    assert {(r.source, r.meet_id, r.status, r.fail_count) for r in files.status(spark, str(tmp_path / "s.json")).collect()} == {("kscore", "k_1", "DONE", 0), ("mso", "2", "RETRYING", 3)}
    (tmp_path / "log.txt").write_text("ok\n[FAIL] 123: timeout\n")
    assert [r.meet_id for r in files.failures(spark, str(tmp_path / "log.txt")).collect()] == ["123"]


def test_sql_dump_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "O'Roe, x", None), (2, "a", "b")], "id int, n string, c string")
    out = str(tmp_path / "dump")
    sinks.insert_statements(df, "t", ("id",)).write.text(out)
    assert sorted(tuple(r) for r in files.dumped_rows(spark, out, ["id", "n", "c"]).collect()) == [("1", "O'Roe, x", None), ("2", "a", "b")]


def test_html(spark):
    page = '<h3>Level 1</h3><table><tr><th>Name</th><th><img alt="Vault"></th><th style="display: none;">x</th></tr><tr><td>Alpha\n Roe</td><td>9.1</td></tr><tr><td>bad</td></tr></table><a href="?id_prop=77">x</a><div data-meetid="5" data-state="AB" data-filter-by="z"><h3>Cup</h3><p class="meet-dates">May 1</p></div>'
    pages = spark.createDataFrame([(1, page), (2, None), (3, "id_prop=77")], "page_id int, html string")
    assert {(r.title, r.header, r.value) for r in html.html_cells(pages, "page_id", "html").collect()} == {("Level 1", "Name", "Alpha Roe"), ("Level 1", "Vault", "9.1")}
    assert [(r.meet_id, r.page_id) for r in html.links(pages, "page_id", "html").collect()] == [("77", 1)]
    r = html.containers(pages, "html").first()
    assert (r.meet_id, r.state, r.filter, r.name, r.dates) == ("5", "AB", "z", "Cup", "May 1")


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    sinks.replace_table(df, p)
    sinks.append_new(spark.createDataFrame([(2, "x"), (3, "c"), (3, "c")], "k int, v string"), p, ["k"])
    assert sorted((r.k, r.v) for r in spark.read.parquet(p).collect()) == [(1, "a"), (2, "b"), (3, "c")]
    u = str(tmp_path / "u")
    sinks.replace_table(spark.range(5), u)
    with pytest.raises(ValueError):
        sinks.swap_table(spark.range(2), u, 3)
    assert spark.read.parquet(u).count() == 5
    sinks.swap_table(spark.range(2), u, 2)
    assert spark.read.parquet(u).count() == 2 and sorted(x.name for x in tmp_path.iterdir()) == ["t", "u"]
    t = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("f", "h1", t), ("g", "h2", t)], "file_path string, file_hash string, last_processed timestamp")
    new = spark.createDataFrame([("f", "h3", t + dt.timedelta(1))], old.schema)
    assert {r.file_path: r.file_hash for r in sinks.ledger(old, new).collect()} == {"f": "h3", "g": "h2"}
    assert sinks.unprocessed(new, old).count() == 1
    assert "| a-b |" in sinks.markdown(spark.createDataFrame([("a|b",)], "c string"), "t", 5)


def test_stream_restarts_where_it_ended(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    t = dt.datetime(2024, 1, 1)
    rows = lambda ids: spark.createDataFrame([(i, t + dt.timedelta(minutes=i)) for i in ids], "id int, ts timestamp_ntz")
    rows([1, 2, 2]).coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    go = lambda: intake.run_available(intake.first_wins(intake.table_stream(spark, src, schema), ["id"], "ts", "1 day"), "ids", out)
    go()
    rows([2, 3]).coalesce(1).write.mode("append").parquet(src)
    go()
    assert sorted(r.id for r in spark.read.parquet(f"{out}/ids").collect()) == [1, 2, 3]


def test_every_nth(spark):
    df = spark.range(103).repartition(8).selectExpr("id", "cast(id as string) as payload", "103 - id as other")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = sorted((r.id, r.payload, r.other) for r in order.every_nth(df, ["id"], 10).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert got == [(i, str(i), 103 - i) for i in range(0, 103, 10)]


def test_catalogue_has_twins():
    assert set(catalogue.QUERIES) == set(catalogue.SQL) and set(upkeep.QUERIES) - set(upkeep.SQL) == {"similar_names"}


def test_decisions(spark):
    from springfloor.operators import curation

    df = spark.createDataFrame([("a", "b", "r", 1), ("c", "d", "r", 2), ("e", "f", "r", 0), ("g", "h", "r", None)], "name_1 string, name_2 string, reason string, choice int")
    aliases, discarded, left = curation.decided(df)
    assert sorted((r.alias, r.canonical) for r in aliases.collect()) == [("b", "a"), ("c", "d")]
    assert discarded.count() == left.count() == 1
    assert [json.loads(r.value)["name_1"] for r in curation.as_json(left).collect()] == ["g"]
