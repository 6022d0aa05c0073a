"""Result files of four sites as facts: one row per athlete and apparatus.

Each adapter takes lines (file, line_no, line) and works within the row: no cell is
shuffled. Rows meet their file's header and facts (id, gender, fallbacks), one row a
file, by joins. ``read_results`` picks the adapter by the source's name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import blank_to_null, column_key, is_number, is_scratch, ksis_cell, mso_cell, to_float
from ..operators.reshape import apparatus_name
from ..runtime import broadcast_if_small, materialize
from .files import records

_TEXT = ("score", "d", "sv", "e", "bonus", "penalty", "rank")
#: The columns of a fact, in order.
FACT = ("source", "file", "row", "source_meet_id", "meet_name", "meet_year", "athlete_name", "club", "gender", "apparatus", "score_final", "score_text", "score_d", "d_text", "score_sv", "score_e", "bonus", "penalty", "rank_text", "calculated", *config.METADATA_COLUMNS, "details_json")


def field(fields: Column, *names: str, exact: bool = False) -> Column:
    """The first value of a row under one of these headers (in any case unless ``exact``)."""
    key = (lambda x: x["header"]) if exact else (lambda x: F.lower(x["header"]))
    hit = F.filter(fields, lambda x: key(x).isin(*names) & x["value"].isNotNull())
    return F.try_element_at(hit, F.lit(1))["value"]


def file_id(file: Column, *marks: str) -> Column:
    """A file's name up to the first of these marks."""
    name = F.regexp_extract(file, r"([^/]*)$", 1)
    return reduce(lambda x, m: F.substring_index(x, m, 1), marks, F.url_decode(name))


def contains_any(x: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda p, q: p | q, [x.contains(w) for w in words])


def first_indicator(headers: Column) -> Column:
    """M or F by the first header that names an apparatus only one has; else null."""
    telling = F.filter(headers, lambda h: contains_any(h, config.MAG_INDICATORS) | contains_any(h, config.WAG_INDICATORS))
    first = F.try_element_at(telling, F.lit(1))
    return F.when(contains_any(first, config.MAG_INDICATORS), "M").when(first.isNotNull(), "F")


def most_indicators(headers: Column) -> Column:
    """M if at least as many headers name a men's apparatus as a women's, and any does."""
    m, w = F.size(F.filter(headers, lambda h: contains_any(h, config.MAG_INDICATORS))), F.size(F.filter(headers, lambda h: contains_any(h, config.WAG_INDICATORS)))
    return F.when((m >= w) & (m > 0), "M").otherwise("F")


def level_then_headers(level: Column, apparatus: Column) -> Column:
    """By the code of a level, women's codes first, else M if only men's apparatus are there."""
    x = F.upper(level)
    only_men = F.arrays_overlap(apparatus, F.array(*[F.lit(a) for a in config.MAG_ONLY])) & ~F.arrays_overlap(apparatus, F.array(*[F.lit(a) for a in config.WAG_ONLY]))
    return F.when(contains_any(x, config.WAG_LEVEL_CODES), "F").when(x.rlike(config.MAG_LEVEL_CODE) | x.contains("PO"), "M").when(only_men, "M").otherwise("F")


def session_or_meet(session: Column, meet: Column) -> Column:
    """F if the session or the meet's name says so, else M."""
    return F.when(F.coalesce(contains_any(F.upper(session), ("WAG", "WOMEN")) , F.lit(False)) | F.coalesce(F.upper(meet).contains("ARTW"), F.lit(False)), "F").otherwise("M")


_RESULT = r"^Result_(.*)_(Score|D|Rnk|E|SV|Bonus|Penalty|Total|Exec_Bonus|Execution_Bonus)$"


def triplets(fields: Column) -> Column:
    """Fields whose repeated apparatus headers are named by occurrence: the first three are
    D, score and rank, later threes are extras. Rows that have Result_ headers stay."""
    base = lambda h: F.substring_index(h, ".", 1)
    raw = lambda h: base(h).isin(*config.RAW_APPARATUS)

    def named(x: Column, i: Column) -> Column:
        k = F.size(F.filter(F.slice(fields, F.lit(1), i), lambda y: base(y["header"]) == base(x["header"])))
        part = F.element_at(F.array(F.lit("D"), F.lit("Score"), F.lit("Rnk")), (k % 3) + 1)
        name = F.when(k < 3, F.concat(F.lit("Result_"), base(x["header"]), F.lit("_"), part)).otherwise(F.concat(F.lit("EXTRA_"), base(x["header"]), F.lit("_"), F.floor(k / 3).cast("string"), F.lit("_"), part))
        return F.struct(x["pos"].alias("pos"), F.when(raw(x["header"]), name).otherwise(x["header"]).alias("header"), x["value"].alias("value"))

    return F.when(F.exists(fields, lambda x: x["header"].startswith("Result_")), fields).otherwise(F.transform(fields, named))


def _wide_results(fields: Column) -> Column:
    """array of (apparatus, score, total, d, sv, e, bonus, penalty, rank) of Result_ columns."""
    bases = F.array_distinct(F.filter(F.transform(fields, lambda x: F.regexp_extract(x["header"], _RESULT, 1)), lambda b: (b != "") & ~F.lower(b).contains("physical")))
    part = lambda b, *suffixes: F.coalesce(*[field(fields, F.concat(F.lit("Result_"), b, F.lit(f"_{s}")), exact=True) for s in suffixes])
    return F.transform(bases, lambda b: F.struct(
        b.alias("apparatus"), part(b, "Score").alias("score"), part(b, "Total").alias("total"), part(b, "D").alias("d"), part(b, "SV").alias("sv"), part(b, "E").alias("e"),
        part(b, "Bonus", "Exec_Bonus", "Execution_Bonus").alias("bonus"), part(b, "Penalty").alias("penalty"), part(b, "Rnk").alias("rank"),
    ))


def _service(fields: Column, taken: tuple[str, ...], aliases: dict[str, str]) -> Column:
    """map of standard name to value of the columns that are no results: those named ``taken``,
    without a name, too long, or with more than four blanks are left out; a header that
    speaks of a day or session gives the session where none is given."""
    keep = lambda x: x["value"].isNotNull() & ~F.lower(x["header"]).isin(*taken) & ~x["header"].rlike("^(Result|EXTRA)_") & ~F.lower(x["header"]).contains("unnamed") & (F.length(x["header"]) <= 60)
    there = F.filter(fields, keep)
    session = F.try_element_at(F.filter(there, lambda x: contains_any(F.lower(x["header"]), config.SESSION_MARKERS)), F.lit(1))["value"]
    short = F.filter(there, lambda x: F.length(x["header"]) - F.length(F.replace(x["header"], F.lit(" "), F.lit(""))) <= 4)
    named = F.transform(short, lambda x: F.struct(column_key(x["header"], aliases).alias("key"), x["value"].alias("value")))
    keys = F.array_distinct(F.transform(named, lambda x: x["key"]))
    own = F.map_from_arrays(keys, F.transform(keys, lambda k: F.filter(named, lambda x: x["key"] == k)[0]["value"]))
    lifted = F.when(session.isNotNull() & ~F.array_contains(keys, F.lit("session")), F.create_map(F.lit("session"), session)).otherwise(F.create_map().cast("map<string,string>"))
    return F.map_concat(own, lifted)


def _facts(rows: DataFrame, source: str, spread: bool = True) -> DataFrame:
    """Facts of rows (file, row, meta, results, ...): metadata routed, scores settled."""
    core = config.METADATA_COLUMNS
    value = lambda k: F.try_element_at("meta", F.lit(k))
    session = F.coalesce(value("session"), value("group"))
    bag = F.map_filter("meta", lambda k, v: ~k.isin(*core))
    named = rows.filter(F.col("athlete_name").isNotNull()).withColumns({"bag": bag, **{c: session if c == "session" else value(c) for c in core}})
    return named.withColumns({"source": F.lit(source), "details_json": F.when(F.size("bag") > 0, F.to_json("bag"))}).drop("bag", "meta")


def _settled(r: Column, move_text: bool) -> Column:
    """struct of a result's numbers and texts: total before score, SV for a missing D, a number
    in D for a word in the score (scratches apart); with ``move_text`` that word becomes
    the rank where there is none."""
    s = F.coalesce(r["total"], r["score"])
    d = F.coalesce(r["d"], r["sv"])
    final = F.when(is_number(F.replace(d, F.lit(","), F.lit(""))) & ~is_number(F.replace(s, F.lit(","), F.lit(""))) & ~is_scratch(s), d).otherwise(s)
    rank = F.coalesce(r["rank"], F.when(~is_number(F.replace(s, F.lit(","), F.lit(""))), s)) if move_text else r["rank"]
    return F.struct(
        apparatus_name(r["apparatus"]).alias("apparatus"), to_float(final).alias("score_final"), F.when(to_float(final).isNull(), final).alias("score_text"), to_float(d).alias("score_d"), F.when(to_float(d).isNull(), d).alias("d_text"),
        to_float(r["sv"]).alias("score_sv"), to_float(r["e"]).alias("score_e"), to_float(r["bonus"]).alias("bonus"), to_float(r["penalty"]).alias("penalty"), rank.alias("rank_text"), F.lit(False).alias("calculated"),
    )


def _with_all_around(rows: DataFrame) -> DataFrame:
    """``rows`` whose results have, where no all-around is among them, its sums, and the sum of
    D for an all-around without D. Column by column, so that nothing is computed anew
    where it is used twice."""
    apart = F.filter("results", lambda r: ~r["apparatus"].isin(config.ALL_AROUND, "Team"))
    total = lambda f: F.aggregate(F.filter("apart", lambda r: r[f].isNotNull()), F.lit(0.0), lambda a, r: a + r[f])
    x = rows.withColumn("apart", apart).withColumns({"sum_score": F.round(total("score_final"), 3), "sum_d": F.round(total("score_d"), 3), "scored": F.exists("apart", lambda r: r["score_final"].isNotNull()), "there": F.exists("results", lambda r: r["apparatus"] == config.ALL_AROUND)})
    d = F.when(F.col("sum_d") > 0, F.col("sum_d"))
    no = lambda kind: F.lit(None).cast(kind)
    made = F.struct(
        F.lit(config.ALL_AROUND).alias("apparatus"), F.col("sum_score").alias("score_final"), no("string").alias("score_text"), d.alias("score_d"), no("string").alias("d_text"),
        no("double").alias("score_sv"), no("double").alias("score_e"), no("double").alias("bonus"), no("double").alias("penalty"), no("string").alias("rank_text"), F.lit(True).alias("calculated"),
    )
    filled = F.transform("results", lambda r: F.when(r["apparatus"] == config.ALL_AROUND, r.withField("score_d", F.coalesce(r["score_d"], d))).otherwise(r))
    out = F.when(F.col("there"), filled).when(F.col("scored"), F.concat("results", F.array(made))).otherwise(F.col("results"))
    return x.withColumn("results", out).drop("apart", "sum_score", "sum_d", "scored", "there")


def _exploded(rows: DataFrame) -> DataFrame:
    # the outer form, as else a filter on the size of results would compute them once more, many times over
    each = rows.select(*[c for c in rows.columns if c not in ("results", "fields")], F.inline_outer("results")).filter("apparatus is not null")
    have = set(each.columns)
    return each.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in FACT])


def _settled_results(fields: Column, move_text: bool) -> Column:
    kept = F.filter(_wide_results(fields), lambda r: r["score"].isNotNull() | r["total"].isNotNull() | r["d"].isNotNull() | r["sv"].isNotNull())
    return F.transform(kept, lambda r: _settled(r, move_text))


def _of_file(rows: DataFrame, **facts: Column) -> DataFrame:
    """``rows`` with facts of their file, each the value of its first row: one row a file,
    written first, so that their size is known and, where small, rows aren't shuffled."""
    first = materialize(rows.groupBy("file").agg(*[F.min_by(c, "row").alias(k) for k, c in facts.items()]))
    return rows.join(broadcast_if_small(first), "file")


def kscore(text: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Facts of files whose results are Result_ columns and whose id is the name before
    ``_FINAL_``; the discipline is that of the first header that tells."""
    rows = records(text, ("name", "gymnast", "athlete"))
    f = F.col("fields")
    rows = _of_file(rows, named=F.coalesce(field(f, "raw_meet_name"), field(f, "meet")), meet_year=field(f, "year"))
    meet_id = F.regexp_replace(file_id(F.col("file"), "_FINAL_"), "^kscore_", "")
    out = rows.select(
        "file", "row", meet_id.alias("source_meet_id"), F.coalesce("named", F.concat(F.lit("Kscore "), meet_id)).alias("meet_name"), "meet_year", field(f, "name", "athlete", "gymnast").alias("athlete_name"), field(f, "club", "team").alias("club"),
        F.coalesce(first_indicator(F.transform(f, lambda x: x["header"])), F.lit("Unknown")).alias("gender"), _service(f, ("name", "athlete", "gymnast", "club", "team"), aliases).alias("meta"), _settled_results(f, True).alias("results"),
    )
    return _exploded(_facts(out, "kscore"))


def livemeet(text: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Facts of files with a header somewhere in the first ten lines, apparatus headers that
    repeat, totals, and all-arounds left to be summed."""
    rows = records(text, ("name", "club"), together=True).withColumn("fields", triplets(F.col("fields")))
    f = F.col("fields")
    rows = _of_file(rows, named=field(f, "meet"))
    out = rows.select(
        "file", "row", file_id(F.col("file"), "_FINAL_", "_PEREVENT_", "_BYEVENT_").alias("source_meet_id"), F.col("named").alias("meet_name"), F.lit(None).cast("string").alias("meet_year"), field(f, "name").alias("athlete_name"), field(f, "club").alias("club"),
        most_indicators(F.transform(f, lambda x: x["header"])).alias("gender"), _service(f, ("name", "club"), aliases).alias("meta"), _settled_results(f, False).alias("results"),
    )
    return _exploded(_with_all_around(_facts(out, "livemeet")))


def mso(text: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Facts of files with an apparatus a column, by short headers, and cells that hold rank,
    thousandths, whole points and bonus."""
    rows = records(text, ("gymnast", "name"))
    f = F.col("fields")
    names = F.create_map(*[x for k, v in {**config.MSO_HEADERS, **{v: v for v in config.MSO_HEADERS.values()}}.items() for x in (F.lit(k), F.lit(v))])
    known = lambda h: F.try_element_at(names, F.trim(h))
    rows = _of_file(rows, named=field(f, "meet"), first_level=field(f, "lvl"))
    cells = F.transform(F.filter(f, lambda x: known(x["header"]).isNotNull() & x["value"].isNotNull()), lambda x: F.struct(known(x["header"]).alias("apparatus"), x["value"].alias("text"), mso_cell(x["value"]).alias("c")))
    no = lambda kind: F.lit(None).cast(kind)
    results = F.transform(F.filter(cells, lambda x: x["c"]["score"].isNotNull()), lambda x: F.struct(
        x["apparatus"].alias("apparatus"), x["c"]["score"].alias("score_final"), x["text"].alias("score_text"), no("double").alias("score_d"), no("string").alias("d_text"), no("double").alias("score_sv"), no("double").alias("score_e"),
        x["c"]["bonus"].alias("bonus"), no("double").alias("penalty"), x["c"]["rank_text"].alias("rank_text"), F.lit(False).alias("calculated"),
    ))
    gender = level_then_headers(F.coalesce("first_level", F.lit("")), F.array_compact(F.transform(f, lambda x: known(x["header"]))))
    taken = ("gymnast", "name", "team", "club", *[h.lower() for h in config.MSO_HEADERS], *[v.lower() for v in config.MSO_HEADERS.values()])
    out = rows.select(
        "file", "row", file_id(F.col("file"), "_mso.csv").alias("source_meet_id"), F.col("named").alias("meet_name"), F.lit(None).cast("string").alias("meet_year"), field(f, "gymnast", "name").alias("athlete_name"), field(f, "team", "club").alias("club"),
        gender.alias("gender"), _service(f, taken, aliases).alias("meta"), results.alias("results"),
    )
    return _exploded(_facts(out, "mso"))


def ksis(text: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Facts of files with code_Total, _D, _E, _Bonus and _ND columns, totals with the rank in
    brackets; session and meet name tell the discipline; the session is the level."""
    rows = records(text, ("name",))
    f = F.col("fields")
    rows = _of_file(rows, named=field(f, "meetname"), meet_year=field(f, "meetyear"), source_meet_id=field(f, "meetid"), first_session=field(f, "session"))
    codes = F.array_distinct(F.filter(F.transform(f, lambda x: F.regexp_extract(x["header"], "^(.*)_Total$", 1)), lambda c: ~c.isin("", "AA")))
    names = F.create_map(*[F.lit(x) for kv in config.KSIS_APPARATUS.items() for x in kv])
    part = lambda c, s: field(f, F.concat(c, F.lit(f"_{s}")), exact=True)

    def result(c: Column) -> Column:
        total = part(c, "Total")
        ranked = total.rlike(r"[\d.]+\(\d+\)")
        score = F.when(ranked, ksis_cell(total)["score"]).otherwise(total)
        return F.struct(
            F.coalesce(F.try_element_at(names, c), c).alias("apparatus"), to_float(score).alias("score_final"), F.when(to_float(score).isNull(), score).alias("score_text"), to_float(part(c, "D")).alias("score_d"), F.when(to_float(part(c, "D")).isNull(), part(c, "D")).alias("d_text"),
            F.lit(None).cast("double").alias("score_sv"), to_float(part(c, "E")).alias("score_e"), to_float(part(c, "Bonus")).alias("bonus"), to_float(part(c, "ND")).alias("penalty"), F.when(ranked, ksis_cell(total)["rank"]).alias("rank_text"), F.lit(False).alias("calculated"),
        )

    aa = field(f, "aa_score")
    no = lambda kind: F.lit(None).cast(kind)
    whole = F.struct(
        F.lit(config.ALL_AROUND).alias("apparatus"), to_float(aa).alias("score_final"), F.when(to_float(aa).isNull(), aa).alias("score_text"), no("double").alias("score_d"), no("string").alias("d_text"), no("double").alias("score_sv"), no("double").alias("score_e"),
        no("double").alias("bonus"), no("double").alias("penalty"), field(f, "place").alias("rank_text"), F.lit(False).alias("calculated"),
    )
    there = F.filter(F.transform(codes, result), lambda r: r["score_final"].isNotNull() | r["score_text"].isNotNull() | r["score_d"].isNotNull())
    results = F.when(aa.isNotNull(), F.concat(F.array(whole), there)).otherwise(there)
    meta = F.map_filter(F.create_map(F.lit("level"), field(f, "session")), lambda k, v: v.isNotNull())
    out = rows.select("file", "row", "source_meet_id", F.col("named").alias("meet_name"), "meet_year", field(f, "name").alias("athlete_name"), field(f, "club").alias("club"), session_or_meet(F.col("first_session"), F.col("named")).alias("gender"), meta.alias("meta"), results.alias("results"))
    return _exploded(_facts(out, "ksis"))


ADAPTERS = {"kscore": kscore, "livemeet": livemeet, "mso": mso, "ksis": ksis}


def read_results(text: DataFrame, source: Column, manifest: DataFrame | None = None, aliases: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts, errors) of lines of files of any site: ``source`` tells a line's site.

    A meet's name and year come from the manifest (meet_id, name, year) where it knows the
    meet, else from the file. errors (file, error): files of an unknown site, and those
    that gave no fact.
    """
    tagged = text.withColumn("__source", source)
    parts = [f(tagged.filter(F.col("__source") == s).drop("__source"), config.COLUMN_ALIASES if aliases is None else aliases) for s, f in ADAPTERS.items()]
    facts = reduce(DataFrame.unionByName, parts)
    if manifest is not None:
        m = manifest.groupBy(F.col("meet_id").alias("source_meet_id")).agg(F.min("name").alias("__name"), F.min("year").alias("__year"))
        facts = facts.join(m, "source_meet_id", "left").withColumns({"meet_name": F.coalesce("__name", "meet_name"), "meet_year": F.coalesce("__year", "meet_year")}).select(*FACT)
    files = tagged.groupBy("file").agg(F.min("__source").alias("__source"))
    unread = files.join(facts.select("file").distinct(), "file", "left_anti")
    known = F.coalesce(F.col("__source").isin(*ADAPTERS), F.lit(False))
    return facts, unread.select("file", F.when(known, "no results found").otherwise(F.concat(F.lit("unknown source "), F.coalesce("__source", F.lit("null")))).alias("error"))
