import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from springfloor.functions import dates, text
from springfloor.operators import reshape


def one(spark, values, f):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = {
    "iso_date": (dates.iso_date, [(None, None), ("", ""), ("2025-01-26", "2025-01-26"), (" 2025-01-26 ", "2025-01-26"), ("Jan 24, 2025 - Jan 26, 2025", "2025-01-26"), ("January 6, 2025", "2025-01-06"), ("Jan 06, 2025", "2025-01-06"), ("26 Jan 2025", "2025-01-26"), ("26 January 2025", "2025-01-26"), ("03/04/2025", "2025-03-04"), ("26/01/2025", "2025-01-26"), ("Spring 2025", "Spring 2025"), ("A - Spring 2025", "Spring 2025"), ("24-26 Jan 2025", "24-26 Jan 2025")]),
    "parse_rank": (text.parse_rank, [("1", 1), ("7T", 7), ("T2", 2), ("Gold", None), ("", None), ("3.0", 30), ("1-2", 12), (None, None)]),
    "leading_int": (text.leading_int, [(None, None), ("7T", 7), (" 12", 12), ("Gold", 0), ("", 0)]),
    "athlete_name": (text.athlete_name, [("Roe, Alpha", "Alpha Roe"), ("ROE ALPHA", "Roe Alpha"), ("alpha   roe", "Alpha Roe"), ("Alpha McRoe", "Alpha McRoe"), ("ALPHA A. ROE", "Alpha Roe"), ("Alpha Ann Roe", "Alpha Ann Roe"), ("O'ROE ALPHA", "O'roe Alpha"), ("Smith-ROE alpha", "Smith-ROE Alpha"), ("Roe, Alpha, Jr", "Alpha, Jr Roe"), ("Unnamed: 3", None), ("#", None), ("42", None), ("X", None), ("Gymnast", None), (" ", None), (None, None)]),
    "title_case": (text.title_case, [(" tovi's gym-club 3d ", "Tovi'S Gym-Club 3D"), ("", None), (None, None)]),
    "without_suffix": (text.without_suffix, [("Open (Session 3 - P3, 4 & 5 (MAG))", "Open"), ("Open (A) (B)", "Open (A)"), ("Open", "Open"), ("Open )", "Open )"), ("", ""), (None, None)]),
    "to_float": (text.to_float, [("1,234.5", 1234.5), ("abc", None), ("9.5d", None), (None, None)]),
    "is_scratch": (text.is_scratch, [("S", True), ("dns", True), ("SC", True), ("SCR-1", True), ("Scratched", True), ("Silver", False), ("9.1", False), (None, False)]),
    "other_sport": (text.other_sport, [("Spring T&T Classic", True), ("TNT Cup", True), ("Open Trampoline", True), ("DMT Open", True), ("Artistic Classic", False), ("Tntrum Cup", False)]),
    "status_word": (text.status_word, [("no show", "DNS"), ("Withdrew", "SCR"), ("9.5", "9.5"), ("", None)]),
    "safe_file_name": (text.safe_file_name, [("a b/c", "a_b_c")]),
    "sql_literal": (text.sql_literal, [(None, "NULL"), ("O'Roe\nx ", "'O''Roe x'")]),
    "apparatus_name": (reshape.apparatus_name, [("Balance_Beam", "Beam"), ("AllAround", "All Around"), ("AA", "All Around"), ("Horizontal Bar", "High Bar"), ("Vault", "Vault"), (None, None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_scalar(spark, name):
    f, cases = CASES[name]
    assert one(spark, [a for a, _ in cases], f) == [b for _, b in cases]


@pytest.mark.parametrize(
    ("legacy", "cases"),
    [
        (False, {"9.500": (9.5, None, None), "500 9": (9.5, None, None), "1 500 9": (9.5, "1", None), "2T 250 9": (9.25, "2T", None), "1 500 9 0.2": (9.5, "1", 0.2), "8.800 5": (5.0088, None, None), "T2 9.250": (None, None, None), "1 x 9": (None, None, None), "a b c d 9.1": (9.1, "a", None), "DNS": (None, None, None)}),
        (True, {"9.500": (9.5, None, None), "500 9": (9.5, None, None), "1 500 9": (9.5, "1", None), "T2 9.250": (9.25, "T2", None), "1 x 9": (9.0, None, None), "a b c d 9.1": (9.1, None, None), "DNS": (None, None, None)}),
    ],
)
def test_mso_cell(spark, legacy, cases):
    got = one(spark, list(cases), lambda c: text.mso_cell(c, legacy))
    assert [(r.score, r.rank_text, r.bonus) for r in got] == list(cases.values())


def test_country(spark):
    rows = [(None, "kscore", None, "CAN"), ("Calgary, AB", "livemeet", None, "CAN"), ("Austin, TX", "mso", None, "USA"), ("Fredericton New Brunswick", "mso", None, "CAN"), (None, "mso", "2025 AAU Open", "USA"), (None, "mso", "Winter Cup", None), ("City in Ontario", "mso", None, "USA")]
    df = spark.createDataFrame(rows, "l string, s string, n string, want string")
    assert all(r.got == r.want for r in df.select("want", text.country(F.col("l"), F.col("s"), F.col("n")).alias("got")).collect())


def test_column_name():
    aliases = {"Sess": "session", "Lvl": "level"}
    cases = {"Sess": "session", "lvl": "level", "Start Value": "start_value", "#": "num", "%": "pct", "": "col_unknown", "SessionID": "sessionid"}
    assert {k: text.column_name(k, aliases) for k in cases} == cases


def test_headers():
    apparatus = ("Pommel Horse", "Parallel Bars")
    raw = ["Name", "Club", *["Pommel Horse"] * 3, *["Parallel Bars"] * 3, "Pommel Horse"]
    want = ["Name", "Club", *[f"Result_{a}_{s}" for a in apparatus for s in ("D", "Score", "Rnk")], "EXTRA_Pommel Horse_1_D"]
    assert reshape.triplet_headers(raw, apparatus) == want
    top = ["#", "Name", "Club", "Floor", "Floor", "Floor", "AllAround", "AllAround", "Level"]
    below = ["", "", "", "D", "Score", "Rnk", "D", "Score", ""]
    assert reshape.two_row_headers(top, below) == ["#", "Name", "Club", "Result_Floor_D", "Result_Floor_Score", "Result_Floor_Rnk", "Result_AllAround_D", "Result_AllAround_Score", "Level"]


def test_similarity_and_ranges(spark):
    df = spark.createDataFrame([("ab cd", "ab ce"), (None, "x")], "a string, b string")
    assert [r.s if r.s is None else round(r.s, 2) for r in df.select(text.similarity("a", "b").alias("s")).collect()] == [0.8, None]
    df = spark.createDataFrame([("Mar 3 - 5", "2024"), ("March 3 & 4, 2024", "2024"), (None, "2023")], "x string, y string")
    got = [str(r.d) for r in df.select(dates.manifest_date(F.lit(None).cast("string"), F.col("x"), F.col("y")).alias("d")).collect()]
    assert got == ["2024-03-03", "2024-03-03", "2023-01-02"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab'\n\" ", max_size=12), min_size=1, max_size=5))
def test_sql_literal_round_trip(spark, values):
    import re

    for v, lit in zip(values, one(spark, values, text.sql_literal)):
        assert lit[1:-1].replace("''", "'") == re.sub(r"[\r\n]+", " ", v).strip(" ")
