"""Rows that fail to parse, set apart with the reason, while valid rows load.

Method: lines are parsed into cells; cells are exploded into (row, column, value)
and joined with a table of rules; failed validations are aggregated per row; the
clean rows are those the errors anti-join away.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import col, small_table

#: What the kinds of rule accept, blanks at both ends taken off.
PATTERNS = {
    "decimal_or_empty": r"^(?:[0-9]+(?:\.[0-9]+)?)?$",
    "score": r"^(?:[0-9]+(?:\.[0-9]+)?|DNS|DNF|SCR|WD)?$",
    "rank": r"^(?:T?0*[1-9][0-9]*|0*[1-9][0-9]*T)?$",
}


@dataclass(frozen=True)
class Layout:
    """Columns of a line in order, and the kind of rule of those that have one."""

    columns: tuple[str, ...]
    rules: dict[str, str]


RESULT_LINES = Layout(("MeetID", "Athlete", "Club", "Level", "Apparatus", "D", "Score", "Rank", "Session"), {"D": "decimal_or_empty", "Score": "score", "Rank": "rank"})


def with_cells(df: DataFrame, line: str) -> DataFrame:
    """``df`` with columns quoted_well (quotes are well-formed) and cells of each line
    under RFC 4180, as JVM expressions.

    Splitting at quotes leaves text outside quotes at even places, inside at odd
    ones. With a comma added at both ends, it is well-formed if the parts are odd in
    number and each outer part is empty (a doubled quote) or has a comma at both ends.
    Linear in the length of the line, without backtracking: nothing in a lambda
    refers to the line as a whole, which would be evaluated anew for each part.
    Blanks around a quoted cell make it malformed, a quote inside a bare cell too.
    Cells are as written.
    """
    parts = F.split(F.concat(F.lit(","), col(line), F.lit(",")), '"', -1)
    fine = F.transform(parts, lambda p, i: (i % 2 == 1) | (p == "") | p.startswith(",") & p.endswith(","))
    # with all quotes gone, a quote can introduce codes: "| is a separator, "_ a quote
    coded = F.transform(parts, lambda p, i: F.when(i % 2 == 1, p).when(p == "", '"_').otherwise(F.replace(p, F.lit(","), F.lit('"|'))))
    cells = F.split(F.array_join(coded, ""), r'"\|', -1)
    inner = F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 2, F.lit(0)))
    return df.withColumns({"quoted_well": (F.size(parts) % 2 == 1) & F.forall(fine, lambda x: x), "cells": F.transform(inner, lambda c: F.replace(c, F.lit('"_'), F.lit('"')))})


def parse_lines(df: DataFrame, key: str, line: str, layout: Layout = RESULT_LINES) -> DataFrame:
    """(key, quoted_well, cells, header) of each line; a null line has null cells."""
    out = with_cells(df.select(col(key).alias(key), col(line).alias("__line")), "__line").drop("__line")
    head = F.array(*[F.lit(c) for c in layout.columns])
    return out.withColumn("header", F.coalesce(F.col("quoted_well") & (F.transform("cells", F.trim) == head), F.lit(False)))


def row_errors(parsed: DataFrame, key: str, layout: Layout = RESULT_LINES) -> DataFrame:
    """(key, reasons) of each line that isn't valid; header lines are none.

    reasons is a sorted array: ``quoting`` or ``cells:<n>`` for the line as a whole
    (n is -1 for a null line), else ``<column>:<rule>`` for each failed cell.
    """
    n = len(layout.columns)
    structural = F.when(F.col("cells").isNull(), F.lit("cells:-1")).when(~F.col("quoted_well"), F.lit("quoting")).when(F.size("cells") != n, F.concat(F.lit("cells:"), F.size("cells").cast("string")))
    # one row per rule: place -1 stands for the line as a whole, whose value is its fault
    rules = F.broadcast(small_table(parsed.sparkSession, [(-1, None, None), *[(layout.columns.index(c), c, kind) for c, kind in layout.rules.items()]], "pos int, rule_column string, rule string"))
    item = lambda pos, value: F.struct(pos.cast("int").alias("pos"), value.alias("value"))
    items = F.when(structural.isNotNull(), F.array(item(F.lit(-1), structural))).otherwise(F.transform("cells", lambda c, i: item(i, c)))
    cells = parsed.filter(~F.col("header")).select(key, F.explode(items).alias("c")).select(key, "c.pos", "c.value")
    value = F.regexp_replace("value", r"^[ \t]+|[ \t]+$", "")
    passed = F.coalesce(*[F.when(F.col("rule") == kind, value.rlike(p)) for kind, p in PATTERNS.items()], F.lit(False))
    reason = F.coalesce(F.concat_ws(":", F.col("rule_column"), F.when(F.col("rule_column").isNotNull(), F.col("rule"))), F.lit(""))
    failed = cells.join(rules, "pos").filter(~passed).select(key, F.when(F.col("pos") < 0, F.col("value")).otherwise(reason).alias("reason"))
    return failed.groupBy(key).agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def valid_rows(parsed: DataFrame, errors: DataFrame, key: str, layout: Layout = RESULT_LINES) -> DataFrame:
    """The lines without errors as columns (blanks taken off, empty cells null)."""
    good = parsed.filter(~F.col("header")).join(errors.select(key), key, "left_anti")
    clean = lambda i: F.nullif(F.regexp_replace(F.col("cells")[i], r"^[ \t]+|[ \t]+$", ""), F.lit(""))
    return good.select(key, *[clean(i).alias(c) for i, c in enumerate(layout.columns)])
