import random
from difflib import SequenceMatcher
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from springfloor.functions import text
from springfloor.operators import candidates, maintenance, order, resolve, sinks
from springfloor.streaming import intake


def test_resolved_names(spark):
    known = spark.createDataFrame([(7, "Al Roe"), (9, "Bo Vell")], "id bigint, name string")
    names = spark.createDataFrame([("Al Roe",), ("Roe Al",), ("Zed",), ("Cy",), ("Cy",), (None,), (" ",), ("Typo",)], "name string")
    alias = spark.createDataFrame([("Roe Al", 7)], "alias string, id bigint")
    typed = spark.createDataFrame([("Typo", "Bo Vell", 0)], "alias string, canonical string, pos int")
    got = {r.name: (r.id, r.created) for r in resolve.resolved_names(names, known, alias, typed).collect()}
    assert got == {"Al Roe": (7, False), "Roe Al": (7, False), "Typo": (9, False), "Cy": (10, True), "Zed": (11, True)}


def test_resolved_meets(spark):
    schema = "meet_db_id bigint, source string, source_meet_id string, name string, comp_year int, start_date_iso string, location string, country string"
    known = spark.createDataFrame([(1, "a", "1", "Unnamed: 3", None, None, "", None), (2, "b", "9", " test CUP ", 2024, "2024-01-01", "Here", "CAN")], schema)
    new = spark.createDataFrame([(None, "a", "1", "Real Name 2023", None, None, "There", None), (None, "c", "5", "Test Cup", None, "2024-05-05", "N/A", None), (None, "d", "1", "New Open", 2022, None, None, None), (None, "e", "1", "new open", 2022, None, "Calgary", None), (None, "f", "1", None, None, None, None, None)], schema)
    got = {r.source: r for r in resolve.resolved_meets(known, new, F.col("start_date_iso"), F.lit(None).cast("string")).collect()}
    assert (got["a"].meet_db_id, got["a"].name, got["a"].comp_year, got["a"].location) == (1, "Real Name 2023", 2023, "There")
    assert (got["c"].meet_db_id, got["c"].location, got["c"].created) == (2, "Here", False)
    assert got["d"].meet_db_id == got["e"].meet_db_id != got["f"].meet_db_id and got["d"].location == "Calgary" and got["f"].created


def test_merge_with_collisions(spark):
    links = spark.createDataFrame([(1, 10, 5), (2, 11, 5), (3, 11, None), (4, 12, None), (5, 10, 5), (6, 20, 1)], "athlete_id int, person_id int, club_id int")
    m = spark.createDataFrame([(11, 10), (12, 10), (10, 10)], "person_id int, canonical int")
    kept, moved = resolve.merged_links(links, m, "person_id", "club_id", "athlete_id")
    assert sorted((r.athlete_id, r.person_id, r.club_id) for r in kept.collect()) == [(1, 10, 5), (3, 10, None), (5, 10, 5), (6, 20, 1)]
    assert sorted((r.athlete_id, r.target) for r in moved.collect()) == [(2, 1), (4, 3)]


def test_similar_against_brute_force(spark):
    rng = random.Random(2)
    first, last = ["aria", "arla", "ada", "bea"], ["roenstad", "roenstat", "rostad", "vellmark", "velmark"]
    names = {f"{rng.choice(first)} {rng.choice(['', 'j. '])}{rng.choice(last)}{rng.choice(['', 'x'])}".title() for _ in range(60)} | {"Bo", "Boo"}
    got = {(r.name_1, r.name_2): r.ratio for r in candidates.similar(spark.createDataFrame([(n,) for n in names] + [(None,), (" ",)], "name string")).collect()}
    key = lambda n: {(w, e) for w in set(n.split()) for v in set(n.split()) - {w} for e in ("<" + v[0], ">" + v[-1])} if len(set(n.split())) > 1 else {("<<", n[:2]), (">>", n[-2:])}
    want = {}
    for a, b in combinations(sorted(names), 2):
        x, y = a.lower(), b.lower()
        r = SequenceMatcher(None, *sorted((x, y))).ratio()
        common = len(set(x.split()) & set(y.split()))
        if key(x) & key(y) and (r > 0.9 or r > 0.8 and common >= min(len(x.split()), len(y.split())) - 1 and len(x.split()) > 1):
            want[a, b] = r
    assert got == want and len(want) > 20


def test_contained_and_turned(spark):
    clubs = spark.createDataFrame([("North Gymnastics Club",), ("Northern Lights",), ("The NORTH Academy",), ("AB Club",), (None,)], "name string")
    brute = {}
    names = [r.name for r in clubs.filter("name is not null").collect()]
    body = {r.name: r.b for r in clubs.filter("name is not null").select("name", text.club_body(F.col("name")).alias("b")).collect()}
    for a in names:
        for b in names:
            if len(body[a]) >= 3 and (len(a), a) < (len(b), b) and body[a].lower() in b.lower() and a.lower() != b.lower():
                brute[b] = min(brute.get(b, a), a, key=lambda x: (len(x), x))
    assert {r.alias: r.canonical for r in candidates.contained(clubs).collect()} == brute
    n = spark.createDataFrame([("Al Roe",), ("roe  al",), ("Al Roe",), ("Bo J. Vell",), ("bo vell",)], "name string")
    assert [(r.name_1, r.name_2) for r in candidates.turned(n).collect()] == [("Al Roe", "roe  al")]
    assert [(r.alias, r.canonical) for r in candidates.without_initial(n).collect()] == [("Bo J. Vell", "bo vell")]


def test_maintenance(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "meet_db_id int, v string")
    ledger = spark.createDataFrame([("d/A1_FINAL_.csv",), ("d/A12_FINAL_.csv",)], "file_path string")
    f, led = maintenance.reset(facts, ledger, spark.createDataFrame([(1, "A1")], "meet_db_id int, source_meet_id string"))
    assert sorted(r.v for r in f.collect()) == ["y", "z"] and [r.file_path for r in led.collect()] == ["d/A12_FINAL_.csv"]
    again = maintenance.replaced(facts, spark.createDataFrame([(2, "new")], "meet_db_id int, v string"), "meet_db_id")
    assert sorted(r.v for r in again.collect()) == ["new", "x", "z"]
    status = spark.createDataFrame([("a", "1", "DONE"), ("a", "2", "DONE"), ("a", "3", "FAILED")], "source string, meet_id string, status string")
    days = spark.createDataFrame([("a", "1", "2024-05-01"), ("a", "2", "2023-01-01"), ("a", "3", "2024-05-01")], "source string, meet_id string, day string").withColumn("day", F.to_date("day"))
    left, backup = maintenance.reopened(status, days, F.lit("2024-01-01").cast("date"))
    assert sorted(r.meet_id for r in left.collect()) == ["2", "3"] and backup.count() == 3
    w = maintenance.widened(spark.createDataFrame([('{"a": "1", "b": 2}',), ("junk",), (None,)], "bag string"), "bag", {"a": "int", "c": "string"}, ("a",))
    assert [(r.a, r.bag) for r in w.collect()] == [(1, '{"b":"2"}'), (None, "junk"), (None, None)]
    seeds = maintenance.seeded(spark.createDataFrame([(1, "old")], "id int, name string"), [(1, "new"), (2, "two")], ["id"])
    assert sorted((r.id, r.name) for r in seeds.collect()) == [(1, "old"), (2, "two")]


def test_numbered(spark):
    df = spark.range(500).repartition(7).selectExpr("id", "id % 3 as g")
    got = {r.id: r.n for r in order.numbered(df, ["g", F.desc("id")], "n").collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == sorted(range(500), key=lambda i: (i % 3, -i))
    assert order.numbered(df.limit(0), ["id"], "n").count() == 0


def test_scheduled_intake(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a", "h1"), ("b", "h1"), ("c", "h2")], "p string, h string").coalesce(1).write.parquet(src)
    stream = lambda: intake.table_stream(spark, src, "p string, h string")
    q = intake.run_available(stream(), "all", out, each=lambda b, _: intake.take_in(b, f"{out}/known", "h"), every="1 second")
    q.processAllAvailable()
    q.stop()
    assert sorted(r.h for r in spark.read.parquet(f"{out}/known").collect()) == ["h1", "h2"]
    assert intake.run_until_idle(lambda: intake.run_available(stream(), "again", out)) == 1


def test_sending_stops_at_the_first_failure(spark):
    calls = []

    def send(chunk):
        if len(calls) == 3:
            raise OSError("refused")
        calls.append(len(chunk))

    assert sinks.sent_in_chunks(spark.range(7), lambda: calls.append("gone"), send, 4) == 7 and calls == ["gone", 4, 3]
    with pytest.raises(OSError):
        sinks.sent_in_chunks(spark.range(9), calls.clear, lambda c: send(c), 2)
    assert calls == [2, 2, 2]


def test_overlapping_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice("abcdefgh") for _ in range(rng.randint(0, 5))] + ["town"] * (i % 3 > 0)) for i in range(60)] + [(99, None)]
    got = {(r.a, r.b): r.common for r in candidates.overlapping(spark.createDataFrame(rows, "id int, ws array<string>"), "id", "ws", 2).collect()}
    want = {(i, j): len(set(x) & set(y)) for (i, x), (j, y) in combinations(rows[:-1], 2) if len(set(x) & set(y)) >= 2}
    assert got == want and len(want) > 100
