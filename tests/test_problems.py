import csv
import datetime as dt
import random

from pyspark.sql import functions as F

from springfloor.operators import badrows, drift, references
from springfloor.operators.references import Reference, orphan_counts, orphan_references

T = dt.datetime


def test_orphans(spark):
    child = spark.createDataFrame([(1, 10, T(2024, 1, 5), "x"), (2, 11, T(2024, 1, 1), "x"), (3, None, T(2024, 1, 1), "x"), (4, 99, T(2024, 2, 1), "x"), (4, 99, T(2024, 2, 1), "x"), (5, 11, None, "x")], "id bigint, ref bigint, t timestamp_ntz, born string")
    parent = spark.createDataFrame([(10, T(2024, 1, 1)), (11, T(2024, 1, 3)), (11, T(2024, 1, 2)), (None, T(2024, 1, 1))], "ref bigint, made timestamp_ntz")
    r = Reference("ref", ("ref",), parent, ("ref",), parent_time="made")
    got = orphan_references(child, "id", [r], "t")
    assert sorted((x.id, x.kind) for x in got.collect()) == [(2, "late"), (4, "missing"), (4, "missing")]
    counts = {(x.month, x.kind): x.n for x in orphan_counts(got, {"ref": "parents"}).collect()}
    assert counts == {("2024-01", "late"): 1, ("2024-02", "missing"): 2}
    assert orphan_references(child.limit(0), "id", [r], "t").count() == 0
    assert orphan_references(child, "id", [Reference("ref", ("ref",), parent.limit(0), ("ref",))]).count() == 5


def test_composite_null_masks(spark):
    child = spark.createDataFrame([(1, 1, 1), (2, 1, 9), (3, 1, None), (4, 9, None), (5, None, None), (6, None, 1)], "id int, a int, b int")
    parent = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
    ids = lambda m: sorted(r.id for r in orphan_references(child, "id", [Reference("ab", ("a", "b"), parent, ("a", "b"), match=m)]).collect())
    assert ids("simple") == [2]
    assert ids("partial") == [2, 4]
    assert ids("full") == [2, 3, 4, 6]


def _valid(line):
    """Brute force: the definition, with the csv module for well-quoted lines."""
    import re

    if line is None:
        return False
    cells, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            m = re.compile(r'"((?:[^"]|"")*)"(?=,|$)').match(line, i)
            if not m:
                return False
            cells.append(m[1].replace('""', '"'))
        else:
            m = re.compile(r'[^",]*(?=,|$)').match(line, i)
            if not m:
                return False
            cells.append(m[0])
        i = m.end()
        if i >= len(line):
            break
        i += 1
    if len(cells) != 9:
        return False
    n = r"[0-9]+(\.[0-9]+)?"
    ok = (rf"({n})?", rf"({n}|DNS|DNF|SCR|WD)?", r"(T?0*[1-9][0-9]*|0*[1-9][0-9]*T)?")
    return all(re.fullmatch(p, c.strip(" \t")) for p, c in zip(ok, cells[5:8]))


def test_bad_rows_against_brute_force(spark):
    rng = random.Random(5)
    good = '1,"Roe, Alpha",Club,Level 1,Vault,5.1, 9.5 ,T3,'
    lines = [None, "", good, ",".join(badrows.RESULT_LINES.columns), "x" * 300_000, '"' * 100_000, '1,"a ""b"" c",C,L,V,,DNS,1,"x"', "1,a,C,L,V,,DNS,T1T,", '1,"a" ,C,L,V,,,,', '1,a"b,C,L,V,,,,', '1,"5",C,L,V,"5"," 9 ","2T",s']
    for _ in range(1500):
        s = list(rng.choice([good, lines[6], lines[10]]))
        for _ in range(rng.randint(1, 3)):
            k = rng.randrange(len(s))
            s[k : k + rng.randint(0, 1)] = rng.choice(['"', ",", "T", "5", " ", '""', "0", "."])
        lines.append("".join(s))
    df = spark.createDataFrame(list(enumerate(lines)), "raw_id bigint, raw_line string").selectExpr("*", "'x' as cells", "1 as value")
    parsed = badrows.parse_lines(df, "raw_id", "raw_line")
    errors = badrows.row_errors(parsed, "raw_id")
    bad = {r.raw_id for r in errors.collect()}
    assert bad == {i for i, x in enumerate(lines) if i != 3 and not _valid(x)}
    valid = {r.raw_id: r for r in badrows.valid_rows(parsed, errors, "raw_id").collect()}
    assert set(valid) == set(range(len(lines))) - bad - {3}
    for i, r in valid.items():
        assert [x.strip(" \t") or None for x in next(csv.reader([lines[i]]))] == [r[c] for c in badrows.RESULT_LINES.columns]
    assert badrows.row_errors(parsed.limit(0), "raw_id").count() == 0


def _drift(spark, files):
    rows = [(f"{feed}/{n}", j, s) for feed, n, rs in files for j, s in rs]
    r = spark.createDataFrame(rows, "source_file string, details_json string, session string").selectExpr("*", "1 as file", "2 as field")
    f = spark.createDataFrame([(f"{feed}/{n}", feed, n) for feed, n, _ in files], "file_path string, feed string, file_seq int")
    schemas = drift.file_schemas(r, "source_file", "details_json", ("session",))
    return schemas, sorted(tuple(x) for x in drift.schema_changes(schemas, f, "file_path", "feed", "file_seq").collect()), r


def test_drift(spark):
    files = [
        ("a", 1, [('{"yob": 2003, "e": 9.5, "Nd": null, "code": "CA236"}', "3"), ('{"yob": 2010, "e": 8.25, "x": true}', "4")]),
        ("a", 2, [('{"born": 2004, "e": "9.5", "code": "CA111"}', None), ('{"born": 2011, "e": "8", "sess": 5, "broken', None), ('{"born": 2011, "sess": 4}', None)]),
        ("a", 4, [('{"other": 1}', None)]),
        ("b", 1, [("[1]", "A"), (None, "B")]),
        ("b", 2, [('{"n": 1, "o": {"k": 1}}', "1"), ('{"n": 1.5}', "A")]),
    ]
    schemas, changes, rows = _drift(spark, files)
    kinds = {(r.file, r.field): r.type for r in schemas.collect()}
    assert kinds["a/1", "yob"] == "integer" and kinds["a/1", "session"] == "integer" and kinds["b/2", "n"] == "number" and kinds["b/2", "session"] == "string" and kinds["b/2", "o"] == "object"
    assert ("a/1", "Nd") not in kinds
    assert changes == sorted([
        ("a", 2, "renamed", "yob", "born"), ("a", 2, "retyped", "e", "e"), ("a", 2, "removed", "x", ""), ("a", 2, "renamed", "session", "sess"),
        ("b", 2, "added", "", "n"), ("b", 2, "added", "", "o"),
    ])
    schema = drift.union_schema(schemas)
    assert dict(schema)["e"] == "string" and dict(schema)["n"] == "number"
    wide = drift.unified(rows, "details_json", schema, ("source_file", "session"))
    assert wide.count() == rows.count() and wide.filter("f_born = 2011").count() == 1
    assert _drift(spark, [("a", 1, [(None, None)]), ("a", 2, [(None, None)])])[1] == []


def test_same_name_but_for_case(spark):
    rows = spark.createDataFrame([("f", '{"nd": 1, "ND": 2}', None)], "source_file string, details_json string, session string")
    schema = drift.union_schema(drift.file_schemas(rows, "source_file", "details_json"))
    assert sorted(drift.unified(rows, "details_json", schema, ("source_file",)).columns) == ["casts_lost", "f_ND", "f_nd_2", "source_file"]


def test_renamed_fields_are_one_column(spark):
    files = [("a", 1, [('{"yob": 2003}', "3"), ('{"yob": 2010, "x": 1}', "4")]), ("a", 2, [('{"born": 2004, "sess": 3}', None), ('{"born": 2011, "sess": 4}', None)]), ("b", 1, [('{"x": "odd", "y": 1}', None)]), ("b", 2, [('{"y": 2, "x": 5}', None)])]
    schemas, _, rows = _drift(spark, files)
    changes = drift.schema_changes(schemas, spark.createDataFrame([(f"{f}/{n}", f, n) for f, n, _ in files], "file_path string, feed string, file_seq int"), "file_path", "feed", "file_seq")
    names = drift.rename_groups(schemas, changes, ("session",))
    assert names["yob"] == names["born"] and names["sess"] == names["session"] == "session" and names["x"] != names["y"]
    one = schemas.withColumn("field", F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("field")))
    got = drift.unified(rows, "details_json", drift.union_schema(one), ("source_file",), names=names, extra=("session",)).collect()
    born = names["yob"]
    assert sorted(r[f"f_{born}"] or 0 for r in got) == [0, 0, 2003, 2004, 2010, 2011] and sorted(r.session for r in got if r.session) == [3, 3, 4, 4] and {r.casts_lost for r in got} == {0}
    lossy = drift.unified(rows, "details_json", [("x", "integer")], ("source_file",)).collect()
    assert sorted(r.casts_lost for r in lossy) == [0, 0, 0, 0, 0, 1]


def test_composite_keys_of_all_matches(spark):
    parent = spark.createDataFrame([("a", 1), ("b", None), ("a", 1)], "p string, q int")
    child = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", None), (4, None, 1), (5, None, 2), (6, None, None), (7, "b", None), (8, "z", None), (1, "a", 1)], "id int, x string, y bigint")
    got = {}
    for m in references.MATCHES:
        r = references.Reference(m, ("x", "y"), parent, ("p", "q"), match=m)
        got[m] = sorted(x.id for x in references.orphan_references(child, "id", [r]).collect())
    assert got == {"simple": [2], "partial": [2, 5, 8], "full": [2, 3, 4, 5, 7, 8]}
