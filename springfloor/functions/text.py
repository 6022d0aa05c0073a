"""Scalar functions on text, all as JVM expressions."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .. import config


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def clean_text(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def is_number(x: Column) -> Column:
    """Whether a number can be read from the text (signs and exponents too); false for null."""
    return F.coalesce(F.trim(x).rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.lit(False))


def to_float(x: Column) -> Column:
    """The number of a text, thousands commas off; null if there is none."""
    y = F.replace(x, F.lit(","), F.lit(""))
    return F.when(is_number(y), F.trim(y).try_cast("double"))


def parse_rank(x: Column) -> Column:
    """All digits of the text as one integer; null without digits."""
    return F.nullif(F.regexp_replace(x, r"[^0-9]", ""), F.lit("")).try_cast("int")


def leading_int(x: Column) -> Column:
    """The integer a text starts with, 0 if with none; null for null."""
    return F.when(x.isNotNull(), F.coalesce(F.nullif(F.regexp_extract(x, r"^\s*([+-]?[0-9]+)", 1), F.lit("")).try_cast("int"), F.lit(0)))


def year_of(x: Column) -> Column:
    """The first year from 2000 to 2099 in the text."""
    return F.nullif(F.regexp_extract(x, r"(20[0-9]{2})", 1), F.lit("")).try_cast("int")


def capitalised(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))


def title_case(x: Column) -> Column:
    """A capital after every character that isn't a letter, small letters after letters;
    ends trimmed, null if empty."""
    runs = F.regexp_extract_all(F.lower(F.trim(x)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.nullif(F.array_join(F.transform(runs, capitalised), ""), F.lit(""))


def athlete_name(x: Column) -> Column:
    """One notation for names: given name first, single spaces, words in capitals or small
    letters capitalised, single-letter middle words dropped; null for garbage."""
    low = F.lower(F.trim(x))
    garbage = low.isin(*config.NAME_GARBAGE) | (F.length(low) <= 1) | low.rlike(r"^[0-9]+$") | low.contains("unnamed:")
    spaced = clean_text(x)
    turned = F.trim(F.regexp_replace(spaced, r"^([^,]*?)\s*,\s*(.*)$", "$2 $1"))
    letter = r"\p{L}"
    words = F.transform(F.split(turned, " "), lambda w: F.when(w.rlike(letter) & ((w == F.upper(w)) | (w == F.lower(w))), capitalised(w)).otherwise(w))
    n = F.size(words)
    kept = F.filter(words, lambda w, i: (i == 0) | (i == n - 1) | (F.length(F.replace(w, F.lit("."), F.lit(""))) > 1))
    return F.when(x.isNotNull() & ~garbage, F.array_join(kept, " "))


def reversed_words(x: Column) -> Column:
    return F.array_join(F.reverse(F.split(x, " ")), " ")


def club_core(x: Column) -> Column:
    """A club's name in small letters without the common words."""
    return clean_text(F.regexp_replace(F.lower(x), r"\b(" + "|".join(config.CLUB_STOP_WORDS) + r")\b", ""))


def club_body(x: Column) -> Column:
    """A club's name without the words that say what kind of body it is."""
    return clean_text(F.regexp_replace(x, r"(?i)\b(" + "|".join(config.CLUB_BODY_WORDS) + r")\b", ""))


def group_level(level: Column, group: Column) -> Column:
    """The level, or where it is blank the first that the group's text names; else empty."""
    named = F.regexp_extract(group, r"(?i)(Level\s*\d+|CCP\s*\d+|P\d+|CPP\s*\d+|Provincial\s*\d+|Junior\s*[A-Z]|Senior\s*[A-Z]|Xcel\s*[a-zA-Z]+)", 1)
    return F.coalesce(blank_to_null(level), named, F.lit(""))


def normal_level(x: Column) -> Column:
    """Small letters, trimmed; empty for null, nan, none."""
    y = F.lower(F.trim(x))
    return F.when(x.isNull() | y.isin("nan", "none"), "").otherwise(y)


def is_scratch(x: Column) -> Column:
    y = F.upper(F.trim(x))
    return F.coalesce(y.isin(*config.SCRATCH_WORDS) | y.startswith("SCR"), F.lit(False))


def status_word(x: Column) -> Column:
    """The standard code of a status, other text as it is; null if empty."""
    y = F.upper(F.trim(x))
    out = reduce(lambda c, kv: c.when(y.isin(*kv[1]), kv[0]), config.STATUS_WORDS.items(), F.when(x == "", None))
    return out.otherwise(x)


def score_warnings(score: Column, d: Column, apparatus: Column, high: float = 16.5, high_d: float = 7.5) -> Column:
    """Warnings joined by '; ', null if there are none."""
    all_around = F.lower(apparatus).contains("all")
    notes = [
        F.when(score < 0, "negative score"), F.when((score > high) & ~all_around, "high score"),
        F.when(d < 0, "negative D"), F.when(d > high_d, "high D"),
    ]
    return F.nullif(F.array_join(F.array_compact(F.array(*notes)), "; "), F.lit(""))


def without_suffix(x: Column) -> Column:
    """A name without a balanced bracket at its end (and blanks before it). Walks from the
    right counting brackets; unbalanced names stay as they are."""
    y = F.trim(x)
    step = lambda s, i: F.when(s["cut"] > 0, s).otherwise(
        F.struct(
            (s["depth"] + F.when(F.substr(y, i, F.lit(1)) == ")", 1).when(F.substr(y, i, F.lit(1)) == "(", -1).otherwise(0)).alias("depth"),
            F.when((F.substr(y, i, F.lit(1)) == "(") & (s["depth"] == 1), i).otherwise(0).alias("cut"),
        )
    )
    walk = F.aggregate(F.sequence(F.length(y), F.lit(1), F.lit(-1)), F.struct(F.lit(0).alias("depth"), F.lit(0).alias("cut")), step)
    return F.when(y.endswith(")") & (F.length(y) > 0), F.when(walk["cut"] > 0, F.trim(F.substr(y, F.lit(1), walk["cut"] - 1))).otherwise(x)).otherwise(x)


def country(location: Column, source: Column, name: Column) -> Column:
    """CAN or USA by source, then the first known code in the location, then a province's
    name in it, then words of the meet's name; else null."""
    loc, nm = F.upper(F.trim(location)), F.upper(name)
    known = F.filter(F.split(loc, r"[,\s]+"), lambda t: t.isin(*config.STATES, *config.PROVINCES))
    first = F.try_element_at(known, F.lit(1))
    contains = lambda c, xs: reduce(lambda p, q: p | q, [c.contains(x) for x in xs])
    return (
        F.when(F.lower(source) == "kscore", "CAN")
        .when(first.isin(*config.STATES), "USA").when(first.isNotNull(), "CAN")
        .when(contains(loc, config.PROVINCES_IN_TEXT), "CAN")
        .when(contains(nm, ("CANADIAN", "CANADA")), "CAN").when(contains(nm, ("USA", "USAG", "AAU")), "USA")
    )


def other_sport(name: Column) -> Column:
    """Whether a meet's name tells of trampoline and tumbling."""
    return F.coalesce(reduce(lambda p, q: p | q, [name.rlike("(?i)" + p) for p in config.OTHER_SPORT]), F.lit(False))


def mso_cell(cell: Column, legacy: bool = False) -> Column:
    """struct(score, rank_text, rank, bonus) of a cell like ``1 500 9``.

    By number of words: score; thousandths and whole; rank before them; bonus after
    them; from five on, rank first and score last. ``legacy`` falls back to the last
    word as score, and takes ranks as numbers.
    """
    w = F.split(clean_text(cell), " ")
    n = F.size(w)
    at = lambda i: F.try_element_at(w, F.lit(i))
    num = lambda c: F.when(is_number(c), c.try_cast("double"))
    both = lambda frac, whole: num(whole) + num(frac) / 1000
    ok3, ok4 = both(at(2), at(3)).isNotNull(), both(at(2), at(3)).isNotNull()
    score = F.when(n == 1, num(at(1))).when(n == 2, both(at(1), at(2))).when(n == 3, both(at(2), at(3))).when(n == 4, both(at(2), at(3))).otherwise(num(at(-1)))
    rank = F.when((n == 3) & ok3 | (n == 4) & ok4 | (n >= 5), at(1))
    if legacy:
        score = F.coalesce(F.when(n <= 4, score), num(at(-1)))
        turned = (n == 2) & both(at(1), at(2)).isNull()
        rank = F.when(n < 5, F.coalesce(F.when(n > 2, rank), F.when(turned & at(1).rlike("[0-9]"), at(1))))
    bonus = F.when((n == 4) & ok4, num(at(4)))
    return F.struct(F.round(score, 4).alias("score"), rank.alias("rank_text"), (parse_rank(rank) if legacy else F.lit(None).cast("int")).alias("rank"), bonus.alias("bonus"))


def ksis_cell(cell: Column) -> Column:
    """struct(score text, rank text) of a cell like ``12.150(5)``."""
    return F.struct(F.trim(F.regexp_extract(cell, r"^([^(]*)", 1)).alias("score"), F.regexp_extract(cell, r"\(([^)]*)\)", 1).alias("rank"))


def sql_literal(x: Column) -> Column:
    """A value as an SQL literal: NULL, or quoted with quotes doubled, line ends as spaces."""
    y = F.trim(F.regexp_replace(x.cast("string"), r"[\r\n]+", " "))
    return F.when(x.isNull(), "NULL").otherwise(F.concat(F.lit("'"), F.replace(y, F.lit("'"), F.lit("''")), F.lit("'")))


def safe_file_name(x: Column) -> Column:
    return F.regexp_replace(F.trim(x), r"[^A-Za-z0-9._-]+", "_")


def column_name(header: str | None, aliases: dict[str, str]) -> str:
    """A header as a column name: by alias, exactly or in any case, else snake case."""
    if not header:
        return "col_unknown"
    raw = header.strip()
    by_case = {k.lower(): v for k, v in reversed(aliases.items())}
    known = aliases.get(raw) or by_case.get(raw.lower())
    return known or re.sub(r"[^a-z0-9]+", "_", raw.lower().replace("#", "num").replace("%", "pct")).strip("_") or "col_unknown"


def column_key(header: Column, aliases: dict[str, str]) -> Column:
    """``column_name`` as an expression over a column of headers."""
    raw = F.trim(header)
    pairs = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv]) if m else F.create_map().cast("map<string,string>")
    by_case = {k.lower(): v for k, v in reversed(aliases.items())}
    plain = F.regexp_replace(F.replace(F.replace(F.lower(raw), F.lit("#"), F.lit("num")), F.lit("%"), F.lit("pct")), "[^a-z0-9]+", "_")
    plain = F.nullif(F.trim(plain, F.lit("_")), F.lit(""))
    return F.coalesce(F.try_element_at(pairs(aliases), raw), F.try_element_at(pairs(by_case), F.lower(raw)), plain, F.lit("col_unknown"))


@pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of two texts, in lexical order (it isn't symmetric)."""
    from difflib import SequenceMatcher

    return pd.Series([None if x is None or y is None else SequenceMatcher(None, *sorted((x, y))).ratio() for x, y in zip(a, b)], dtype="float64")
