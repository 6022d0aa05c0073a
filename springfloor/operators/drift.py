"""Schemas that drift between files: one consistent table and a log of every change.

Method: the schema of each file is read in parallel (one aggregation with
map-side combine), folded through a type-promotion lattice to the union schema,
to which all files are cast; differences of neighbouring files are logged in
order. Neighbours meet by an equi-join on (feed, number - 1), not by a window
over a feed, so a feed may hold any share of the files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import col, materialize

#: The JSON types, each a bit of a file's mask.
TYPES = {"string": 1, "integer": 2, "number": 4, "boolean": 8, "object": 16, "array": 32}
#: How alike the content of a vanished and a new field must be, of 1, to be one renamed field.
SAME_CONTENT = 0.4


def promoted(mask: Column) -> Column:
    """Least type of the lattice above all types of a bit mask.

    integer < number < string; boolean, object and array each < string.
    """
    out = F.when(mask == TYPES["integer"] | TYPES["number"], "number")
    for name, bit in TYPES.items():
        out = out.when(mask == bit, name)
    return out.otherwise("string")


def _json_type(schema: Column) -> Column:
    """Bit of a value's JSON type, from what schema_of_variant says; null for JSON null."""
    return (
        F.when(schema == "STRING", TYPES["string"])
        .when(schema == "BIGINT", TYPES["integer"])
        .when(schema.startswith("DECIMAL") | (schema == "DOUBLE") | (schema == "FLOAT"), TYPES["number"])
        .when(schema == "BOOLEAN", TYPES["boolean"])
        .when(schema.startswith("OBJECT"), TYPES["object"])
        .when(schema.startswith("ARRAY"), TYPES["array"])
    )


def _bit(text: Column) -> Column:
    """One of 64 bits, by hash."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(text), F.lit(64)).cast("int"))


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_FROM = _LETTERS + _LETTERS.upper() + "0123456789"
_TO = "a" * 26 + "A" * 26 + "9" * 10


def field_values(rows: DataFrame, file: str, payload: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(file, field, bit, text, structure) of each non-null value: the top-level keys of
    the JSON object ``payload``, and the string columns ``extra``, whose values count
    as integers if all digits. Unreadable JSON gives nothing."""
    tvf = rows.sparkSession.tvf
    none = F.lit(None)
    item = lambda v, name, text: F.struct(v.alias("v"), name.cast("string").alias("name"), text.cast("string").alias("extra"))
    # the payload and the extra columns come from one generator, so the table is read once
    items = F.array(item(F.try_parse_json(col(payload)), none, none), *[item(F.try_parse_json(none.cast("string")), F.lit(c), col(c)) for c in extra])
    each = rows.select(col(file).alias("file"), F.inline(items)).filter("v is not null or extra is not null")
    v = each.lateralJoin(tvf.variant_explode_outer(F.col("v").outer())).filter("key is not null or extra is not null")
    structure = F.schema_of_variant("value")
    whole = F.when(F.col("extra").rlike("^[0-9]+$"), TYPES["integer"]).otherwise(TYPES["string"])
    out = v.select(
        "file", F.coalesce("name", "key").alias("field"), F.when(F.col("name").isNotNull(), whole).otherwise(_json_type(structure)).alias("bit"),
        F.coalesce("extra", F.expr("try_variant_get(value, '$', 'string')")).alias("text"), F.when(F.col("name").isNotNull(), "").otherwise(structure).alias("structure"),
    )
    return out.filter("bit is not null")


def field_texts(rows: DataFrame, file: str, payload: str) -> DataFrame:
    """(file, field, json) of each non-null top-level value of the JSON objects, as JSON text."""
    base = rows.select(col(file).alias("file"), F.try_parse_json(col(payload)).alias("v")).filter("v is not null")
    v = base.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer())).filter("key is not null and not is_variant_null(value)")
    return v.select("file", F.col("key").alias("field"), F.to_json("value").alias("json"))


def file_schemas(rows: DataFrame, file: str, payload: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """(file, field, type, n, shapes, lo, hi): one row per file and field.

    A profile of the content comes along, of bounded size: shapes, 64 bits hashed
    from the values' patterns (letters and digits by class; for objects and arrays
    their structure), and the range of numeric values. Mixed types are promoted,
    except that an extra column is an integer only if all its values are.
    """
    v = field_values(rows, file, payload, extra)
    structured = F.col("bit") >= TYPES["object"]
    shape = F.when(structured, F.regexp_replace("structure", r"\([0-9]+,[0-9]+\)", "")).when(F.col("bit") == TYPES["string"], F.translate("text", _FROM, _TO)).otherwise("")
    number = F.when(~structured, F.col("text").try_cast("double"))
    g = v.groupBy("file", "field").agg(
        F.bit_or("bit").alias("mask"), F.count(F.lit(1)).alias("n"), F.bit_or(_bit(shape)).alias("shapes"), F.min(number).alias("lo"), F.max(number).alias("hi")
    )
    return g.select("file", "field", promoted(F.col("mask")).alias("type"), "n", "shapes", "lo", "hi")


def union_schema(schemas: DataFrame) -> list[tuple[str, str]]:
    """The fields of all files with their promoted types, sorted. Its size is that of
    one table header, whatever the number of files."""
    mask = F.coalesce(*[F.when(F.col("type") == k, b) for k, b in TYPES.items()])
    g = schemas.groupBy("field").agg(promoted(F.bit_or(mask)).alias("type"))
    return [(r.field, r.type) for r in g.orderBy("field").collect()]


def rename_groups(schemas: DataFrame, changes: DataFrame, extra: tuple[str, ...] = ()) -> dict[str, str]:
    """Each field of the files to the one name it has in the unified table.

    The change log says which fields were renamed; such fields are one, the most frequent
    rename first, unless some file has both (or fields that are already one with
    them), as then a value would be lost. A group has the name of its column in
    ``extra``, else of the field that most files have. What is collected is bounded by
    the number of different field names, squared.
    """
    renames = changes.filter("change_kind = 'renamed'").groupBy("field_before", "field_after").agg(F.count(F.lit(1)).alias("n")).collect()
    a, b = schemas.select("file", F.col("field").alias("a")), schemas.select("file", F.col("field").alias("b"))
    together = {frozenset((r.a, r.b)) for r in a.join(b, "file").filter("a < b").select("a", "b").distinct().collect()}
    files = {r.field: r.n for r in schemas.groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
    group = {f: {f} for f in files}
    for r in sorted(renames, key=lambda r: (-r.n, r.field_before, r.field_after)):
        p, q = group.get(r.field_before), group.get(r.field_after)
        if p is not None and q is not None and p is not q and not any(frozenset((x, y)) in together for x in p for y in q):
            p |= q
            for f in q:
                group[f] = p
    return {f: min(g, key=lambda x: (x not in extra, -files[x], x)) for f, g in group.items()}


def unified(rows: DataFrame, payload: str, schema: list[tuple[str, str]], keep: tuple[str, ...], prefix: str = "f_", names: dict[str, str] | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """All rows with the columns ``keep``, one column per field of the union schema, cast to its
    type (null where absent, null or in unreadable JSON), and ``casts_lost``.

    With ``names`` (rename_groups), fields that are one come in one column: a column of
    ``extra`` first, then the fields by name; schema then has the names of the groups.
    Objects, arrays and mixed fields come as JSON text. Names that differ in case
    only, or clash with kept columns, get a running number. casts_lost counts the
    fields of the row whose value could not be cast to the column's type.
    """
    sql = {"integer": "bigint", "number": "double", "boolean": "boolean"}
    taken, out, lost = {c.lower() for c in keep}, [], []
    v = F.try_parse_json(col(payload))
    members: dict[str, list[str]] = {}
    for f, g in sorted((names or {f: f for f, _ in schema}).items()):
        members.setdefault(g, []).append(f)
    texts, plan = [], []
    for i, (field, kind) in enumerate(schema):
        name, k = field if field in extra else prefix + field, 1
        while name.lower() in taken:
            k += 1
            name = f"{prefix}{field}_{k}"
        taken.add(name.lower())
        own = [col(c).cast("string") for c in members[field] if c in extra]
        paths = ["$['" + f.replace("\\", "\\\\").replace("'", "\\'") + "']" for f in members[field] if f not in extra]
        texts.append(F.coalesce(*own, *[F.try_variant_get(F.col("__v"), p, "string") for p in paths]).alias(f"__t{i}"))
        plan.append((name, sql.get(kind)))
    read = rows.withColumn("__v", v).select(*[col(c).alias(c) for c in keep], *texts)
    for i, (name, kind) in enumerate(plan):
        text = F.col(f"__t{i}")
        out.append((text.try_cast(kind) if kind else text).alias(name))
        if kind:
            lost.append((text.isNotNull() & text.try_cast(kind).isNull()).cast("int"))
    return read.select(*[col(c) for c in keep], *out, reduce(lambda p, q: p + q, lost, F.lit(0)).alias("casts_lost"))


def _alike(a: str, b: str) -> Column:
    """How alike two profiles (columns prefixed a and b) are, 0 to 1."""
    c = lambda side, x: F.col(f"{side}_{x}")
    both, any_ = c(a, "shapes").bitwiseAND(c(b, "shapes")), c(a, "shapes").bitwiseOR(c(b, "shapes"))
    shapes = F.bit_count(both) / F.bit_count(any_)
    unit = F.when(F.col("type") == "number", 0.0).otherwise(1.0)  # whole numbers fill a range to its end
    span = F.greatest(c(a, "hi"), c(b, "hi")) - F.least(c(a, "lo"), c(b, "lo")) + unit
    common = F.least(c(a, "hi"), c(b, "hi")) - F.greatest(c(a, "lo"), c(b, "lo")) + unit
    one_sided = c(a, "lo").isNull() != c(b, "lo").isNull()
    ranges = F.when(one_sided, 0.0).when(c(a, "lo").isNull(), 1.0).when(span == 0, 1.0).otherwise(F.greatest(F.lit(0.0), common / span))
    return F.least(shapes, ranges)


def schema_changes(schemas: DataFrame, files: DataFrame, file: str, feed: str, number: str, threshold: float = SAME_CONTENT) -> DataFrame:
    """(feed, file_seq, change_kind, field_before, field_after): each file against the one
    numbered one less in its feed.

    A field gone and one new in the same file are ``renamed`` if their types are
    equal and their content is alike: patterns of the values, and the numeric range,
    each within the two files or over the feed, whichever agrees better. The most
    alike pairs are taken first, each field once. A file without a predecessor has
    no changes; a file without fields drops all of them. Repeated rows don't matter.
    """
    f = files.select(col(file).alias("file"), col(feed).alias("feed"), col(number).alias("seq")).filter("feed is not null and seq is not null")
    known = materialize(f.join(schemas, "file"))
    has_before = f.select("feed", (F.col("seq") + 1).alias("seq")).distinct()
    has_after = f.select("feed", "seq").distinct()
    prof = ["type", "shapes", "lo", "hi"]
    pooled = known.groupBy("feed", "field", "type").agg(F.bit_or("shapes").alias("shapes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    now = known.join(has_before, ["feed", "seq"]).select("feed", "seq", "field", *[F.col(x).alias(f"b_{x}") for x in prof])
    before = known.withColumn("seq", F.col("seq") + 1).join(has_after, ["feed", "seq"]).select("feed", "seq", "field", *[F.col(x).alias(f"a_{x}") for x in prof])
    both = before.join(now, ["feed", "seq", "field"], "full")
    changed = both.filter("a_type is null or b_type is null or a_type != b_type")
    retyped = changed.filter("a_type is not null and b_type is not null").select("feed", "seq", F.lit("retyped").alias("kind"), F.col("field").alias("x"), F.col("field").alias("y"))
    gone = changed.filter("b_type is null").select("feed", "seq", F.col("field").alias("x"), F.col("a_type").alias("type"), "a_shapes", "a_lo", "a_hi")
    new = changed.filter("a_type is null").select("feed", "seq", F.col("field").alias("y"), F.col("b_type").alias("type"), "b_shapes", "b_lo", "b_hi")
    wide = lambda side, name: pooled.select("feed", F.col("field").alias(name), "type", *[F.col(x).alias(f"{side}_{x}") for x in prof[1:]])
    pairs = gone.join(new, ["feed", "seq", "type"]).join(wide("pa", "x"), ["feed", "x", "type"]).join(wide("pb", "y"), ["feed", "y", "type"])
    pairs = pairs.withColumn("alike", F.greatest(_alike("a", "b"), _alike("pa", "pb"))).filter(F.col("alike") >= threshold)
    # a group holds at most (fields of a header)^2 / 4 pairs
    ranked = pairs.groupBy("feed", "seq").agg(F.array_sort(F.collect_list(F.struct((-F.col("alike")).alias("d"), "x", "y"))).alias("ps"))
    start = F.array().cast("array<struct<d:double,x:string,y:string>>")
    chosen = F.aggregate("ps", start, lambda acc, p: F.when(F.exists(acc, lambda q: (q.x == p.x) | (q.y == p.y)), acc).otherwise(F.concat(acc, F.array(p))))
    renamed = ranked.select("feed", "seq", F.explode(chosen).alias("p")).select("feed", "seq", F.lit("renamed").alias("kind"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    removed = gone.join(renamed.select("feed", "seq", "x"), ["feed", "seq", "x"], "left_anti").select("feed", "seq", F.lit("removed").alias("kind"), "x", F.lit("").alias("y"))
    added = new.join(renamed.select("feed", "seq", "y"), ["feed", "seq", "y"], "left_anti").select("feed", "seq", F.lit("added").alias("kind"), F.lit("").alias("x"), "y")
    out = retyped.unionByName(renamed).unionByName(removed).unionByName(added)
    return out.select("feed", F.col("seq").alias("file_seq"), F.col("kind").alias("change_kind"), F.col("x").alias("field_before"), F.col("y").alias("field_after"))
