"""Reshaping and normalising rows of result files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import blank_to_null, is_scratch, to_float
from ..runtime import col

RESULT_COLUMN = re.compile(r"^Result_(.*)_(Score|D|Rnk|E|SV|Bonus|Penalty|Total|Exec_Bonus|Execution_Bonus)$")
#: Parts of a result and what they are called.
PARTS = {"Score": "score", "D": "d", "Rnk": "rank", "E": "e", "SV": "sv", "Bonus": "bonus", "Exec_Bonus": "execution_bonus", "Execution_Bonus": "execution_bonus", "Penalty": "penalty", "Total": "total"}


def result_columns(columns: list[str]) -> dict[str, dict[str, str]]:
    """Apparatus to {part: column}, in the order of the header."""
    out: dict[str, dict[str, str]] = {}
    for c in columns:
        m = RESULT_COLUMN.match(c)
        if m and "physical" not in c.lower():
            out.setdefault(m[1], {})[PARTS[m[2]]] = c
    return out


def apparatus_name(x: Column) -> Column:
    """The standard name of an apparatus."""
    y = F.replace(F.trim(x), F.lit("_"), F.lit(" "))
    return reduce(lambda c, kv: c.when(y == kv[0], kv[1]), config.APPARATUS_NAMES.items(), F.when(y.isNull(), None)).otherwise(y)


def triplet_headers(header: list[str], apparatus: tuple[str, ...], suffixes: tuple[str, ...] = ("D", "Score", "Rnk")) -> list[str]:
    """Headers in which an apparatus repeats, named by occurrence: the first three are
    its D, score and rank, later threes are extras."""
    seen: dict[str, int] = {}
    out = []
    for h in header:
        base = h.strip()
        if base not in apparatus:
            out.append(h)
            continue
        k = seen[base] = seen.get(base, -1) + 1
        out.append(f"Result_{base}_{suffixes[k]}" if k < len(suffixes) else f"EXTRA_{base}_{k // len(suffixes)}_{suffixes[k % len(suffixes)]}")
    return out


def header_row(rows: list[list[str]], words: tuple[str, ...] = ("name", "athlete", "gymnast", "competitor")) -> int:
    """The first of the leading rows with a cell that is one of the words; -1 if there is none."""
    return next((i for i, r in enumerate(rows) if any(c.strip().lower() in words for c in r)), -1)


def without_index(header: list[str]) -> list[int]:
    """Positions of a header without a leading index column (blank, unnamed or ``#``-less number)."""
    first = header[0].strip().lower() if header else "x"
    return list(range(1 if first == "" or first.startswith("unnamed") or first == "0" else 0, len(header)))


def two_row_headers(top: list[str], below: list[str]) -> list[str]:
    """One header from two rows: an apparatus over D, Score (and Rnk) becomes a pair or a
    triple, over blanks a score; names that repeat get a running number."""
    out: list[str] = []
    last = ""
    for t, b in zip(top, below + [""] * (len(top) - len(below))):
        t, b = t.strip(), b.strip()
        last = t or last
        name = f"Result_{last}_{b}" if b in ("D", "Score", "Rnk") else t or b
        k, base = 1, name
        while name in out:
            k += 1
            name = f"{base}_{k}"
        out.append(name)
    return out


def unpivot_results(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key and apparatus, all parts as text; those without score, D and start
    value are dropped. One generator, no shuffle."""
    found = result_columns(rows.columns)
    parts = list(dict.fromkeys(PARTS.values()))
    item = lambda a, ps: F.struct(F.lit(a).alias("apparatus"), *[(blank_to_null(col(ps[p])) if p in ps else F.lit(None).cast("string")).alias(p) for p in parts])
    out = rows.select(*keys, F.explode(F.array(*[item(a, ps) for a, ps in found.items()])).alias("r")).select(*keys, "r.*")
    return out.filter("score is not null or total is not null or d is not null or sv is not null").withColumn("apparatus", apparatus_name(F.col("apparatus")))


def settled_scores(rows: DataFrame) -> DataFrame:
    """Totals before scores, start values for missing D, a number in D for a word in the
    score (scratches apart), whose word then is the rank if there is none; numbers and texts apart."""
    s = F.coalesce(F.col("total"), F.col("score"))
    d = F.coalesce(F.col("d"), F.col("sv"))
    number = lambda x: to_float(x).isNotNull()
    swap = number(d) & ~number(s) & ~is_scratch(s)
    word = ~number(s) & s.isNotNull()
    rank = F.when(F.col("rank").isNull() & word, s).otherwise(F.col("rank"))
    final = F.when(swap, d).otherwise(s)
    return rows.withColumns(
        {"score_final": to_float(final), "score_text": F.when(~number(final), final), "score_d": to_float(d), "d_text": F.when(~number(d), d), "rank_text": rank}
    ).drop("score", "total", "d", "sv", "rank")


def routed_metadata(rows: DataFrame, columns: list[str], aliases: dict[str, str], core: tuple[str, ...] = config.METADATA_COLUMNS) -> DataFrame:
    """Service columns by their standard names: known ones as columns, the rest in
    details_json; a group is the session where none is given."""
    from ..functions.text import column_name

    named: dict[str, list[str]] = {}
    for c in columns:
        named.setdefault(column_name(c, aliases), []).append(c)
    value = lambda cs: F.coalesce(*[blank_to_null(col(c)) for c in cs])
    kept = {n: value(cs) for n, cs in named.items() if n in core}
    rest = {n: value(cs) for n, cs in named.items() if n not in core}
    if "group" in kept:
        kept["session"] = F.coalesce(kept.get("session", F.lit(None).cast("string")), kept["group"])
    bag = F.map_filter(F.create_map(*[x for n, v in rest.items() for x in (F.lit(n), v)]), lambda k, v: v.isNotNull()) if rest else F.create_map().cast("map<string,string>")
    other = [c for c in rows.columns if c not in columns]
    return rows.select(*[col(c).alias(c) for c in other], *[v.alias(n) for n, v in kept.items()], F.when(F.size(bag) > 0, F.to_json(bag)).alias("details_json"))


def with_all_around(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (score_final, score_d per apparatus) and, for athletes without an all-around
    row, one with the sums; a missing all-around D becomes the sum of D."""
    g = rows.groupBy(*keys).agg(
        F.max((F.col("apparatus") == config.ALL_AROUND).cast("int")).alias("has"),
        F.sum(F.when(F.col("apparatus") != config.ALL_AROUND, F.col("score_final").cast("decimal(9,3)"))).alias("s"),
        F.sum(F.when(F.col("apparatus") != config.ALL_AROUND, F.col("score_d").cast("decimal(9,3)"))).alias("d"),
    )
    d = F.when(F.col("d") > 0, F.col("d").cast("double"))
    made = g.filter("has = 0 and s is not null").select(*keys, F.lit(config.ALL_AROUND).alias("apparatus"), F.col("s").cast("double").alias("score_final"), d.alias("score_d"), F.lit(True).alias("calculated"))
    filled = rows.join(g.select(*keys, d.alias("sum_d")), keys, "left").withColumn("score_d", F.when(F.col("apparatus") == config.ALL_AROUND, F.coalesce("score_d", "sum_d")).otherwise(F.col("score_d"))).drop("sum_d")
    return filled.withColumn("calculated", F.lit(False)).unionByName(made, allowMissingColumns=True)


def folded(rows: DataFrame, keep: list[str], bag: str) -> DataFrame:
    """All columns but ``keep`` folded into the JSON object ``bag``; text there that isn't
    an object is kept under ``raw``, and the columns win over its keys."""
    extra = [c for c in rows.columns if c not in keep and c != bag]
    old = F.from_json(col(bag), "map<string,string>")
    empty = F.create_map().cast("map<string,string>")
    base = F.when(col(bag).isNull(), empty).when(F.coalesce(F.json_object_keys(col(bag)).isNotNull(), F.lit(False)), old).otherwise(F.create_map(F.lit("raw"), col(bag)))
    new = F.map_filter(F.create_map(*[x for c in extra for x in (F.lit(c), col(c).cast("string"))]), lambda k, v: v.isNotNull()) if extra else empty
    merged = F.map_zip_with(base, new, lambda k, o, n: F.coalesce(n, o))
    return rows.select(*keep, F.when(F.size(merged) > 0, F.to_json(merged)).alias(bag))


def grid(rows: DataFrame, keys: list[str], gender: str) -> DataFrame:
    """A wide row as three: final score, D and rank over the apparatus."""
    order = config.GOLD_ORDER[gender]
    lines = [F.struct(F.lit(i).alias("line"), F.lit(label).alias("metric"), *[F.col(f"{p}_{x}").alias(p) for p, _ in order]) for i, (label, x) in enumerate((("Final Score", "score"), ("D Score", "d"), ("Rank", "rank")))]
    return rows.select(*keys, F.explode(F.array(*lines)).alias("g")).select(*keys, "g.*").drop("line")
