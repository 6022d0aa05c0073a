"""Tables and links of fetched HTML pages.

Pages are parsed by the standard library's parser, a batch of pages at a time, where
they are read; what comes out is plain rows, and the layouts are built from these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..runtime import col


def _plain(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


@dataclass
class _Cell:
    text: list[str] = field(default_factory=list)
    anchor: list[str] = field(default_factory=list)
    last: list[str] = field(default_factory=list)  # text since the last line break
    hidden: bool = False


@dataclass
class _Table:
    number: int
    title: str
    group: str
    code: str
    rows: list[list[_Cell]] = field(default_factory=list)
    floats: list[list[_Cell]] = field(default_factory=list)  # cells after each row and outside any
    images: list[str] = field(default_factory=list)
    row: list[_Cell] | None = None
    cell: _Cell | None = None


class Tables(HTMLParser):
    """All tables of a page, nested ones apart, in the order in which they begin.

    A cell's text has single blanks, an image gives its alt text. title is the last
    heading before the table, group the text of the last subtitle that names an age
    group, code the table's age partition.
    """

    def __init__(self, page: str) -> None:
        super().__init__()
        self.done: list[_Table] = []
        self.open: list[_Table] = []
        self.title, self.group = "", ""
        self.heading: list[str] | None = None
        self.subtitle: list[str] | None = None
        self.link = False
        self.feed(page)
        self.close()
        self.done.sort(key=lambda t: t.number)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = {k: v or "" for k, v in attrs}
        top = self.open[-1] if self.open else None
        if tag == "table":
            table = _Table(len(self.done), self.title, self.group, a.get("data-agepartitioncd", ""))
            self.open.append(table)
            self.done.append(table)
        elif tag in ("h1", "h2", "h3", "h4"):
            self.heading = []
        elif "rpSubTitle" in a.get("class", "").split():
            self.subtitle = []
        elif top and tag == "tr":
            self.end_cell(top)
            top.row = []
            top.rows.append(top.row)
            top.floats.append([])
        elif top and tag in ("td", "th"):
            self.end_cell(top)
            top.cell = _Cell(hidden="display:none" in a.get("style", "").replace(" ", "").lower())
            if top.row is not None:
                top.row.append(top.cell)
            elif top.floats:
                top.floats[-1].append(top.cell)
        elif top and tag == "img":
            top.images.append(a.get("src", ""))
            self.handle_data(a.get("alt", ""))
        elif top and top.cell and tag == "a":
            self.link = True
        elif top and top.cell and tag == "br":
            top.cell.text.append(" ")
            top.cell.last = []

    @staticmethod
    def end_cell(table: _Table) -> None:
        table.cell = None

    def handle_endtag(self, tag: str) -> None:
        top = self.open[-1] if self.open else None
        if tag in ("h1", "h2", "h3", "h4") and self.heading is not None:
            self.title, self.heading = _plain(self.heading), None
        elif self.subtitle is not None and tag in ("div", "span", "p"):
            found = re.match(r"\(Age Group:(.*?)\)?$", _plain(self.subtitle))
            self.group = found[1].strip() if found else self.group
            self.subtitle = None
        elif tag == "a":
            self.link = False
        elif top and tag in ("td", "th"):
            self.end_cell(top)
        elif top and tag == "tr":
            self.end_cell(top)
            top.row = None
        elif top and tag == "table":
            self.open.pop()

    def handle_data(self, data: str) -> None:
        cell = self.open[-1].cell if self.open else None
        if cell is not None:
            cell.text.append(data)
            cell.last.append(data)
            if self.link:
                cell.anchor.append(data)
        elif self.heading is not None:
            self.heading.append(data)
        elif self.subtitle is not None:
            self.subtitle.append(data)


def _parsed(pages: DataFrame, key: str, html: str, rows_of, schema: str) -> DataFrame:
    """A row for each that ``rows_of`` yields for a page's tables; null pages have none."""
    kind = pages.schema[key].dataType.simpleString()
    names = [f.split()[0] for f in re.split(r",\s*(?![^<]*>)", schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(k, *r) for k, page in zip(b["key"], b["page"]) if page is not None for r in rows_of(Tables(page).done)]
            yield pd.DataFrame(out, columns=["key", *names])

    narrow = pages.select(col(key).alias("key"), col(html).alias("page"))
    return narrow.mapInPandas(run, f"key {kind}, {schema}").withColumnRenamed("key", key)


def _body_rows(tables: list[_Table]) -> Iterator[tuple]:
    for t in tables:
        shown = [[_plain(c.text) for c in r if not c.hidden] for r in t.rows]
        shown = [r for r in shown if r]
        for i, cells in enumerate(shown[1:], 1):
            yield t.number, t.title, t.group, t.code, i, shown[0] if len(cells) == len(shown[0]) else None, cells


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, title, age_group, age_code, row_no, header, cells): each row of each
    table but the first, which is its header. Hidden cells are left out; a row of another
    width than the header has a null header."""
    return _parsed(pages, key, html, _body_rows, "table_no int, title string, age_group string, age_code string, row_no int, header array<string>, cells array<string>")


def html_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, title, row_no, header, value) of all cells of rows as wide as their header."""
    rows = table_rows(pages, key, html).filter("header is not null")
    each = rows.select(key, "table_no", "title", "row_no", F.posexplode(F.arrays_zip("header", "cells")).alias("pos", "x"))
    return each.select(key, "table_no", "title", "row_no", F.col("x.header").alias("header"), F.col("x.cells").alias("value"))


def event_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, row_no, age_code, values): the rows of all tables of a page as maps of
    header to value; a header that repeats in its table gets a running number."""
    rows = table_rows(pages, key, html).filter("header is not null")
    before = lambda h, i: F.size(F.filter(F.slice("header", F.lit(1), i), lambda x: x == h))
    names = F.transform("header", lambda h, i: F.when(before(h, i) > 0, F.concat(h, F.lit("_"), before(h, i).cast("string"))).otherwise(h))
    return rows.select(key, "table_no", "row_no", F.nullif("age_code", F.lit("")).alias("age_code"), F.map_from_arrays(names, "cells").alias("values"))


#: What one site calls the parts of a result.
_PARTS = {"D-Score": "D", "SV": "D", "E Score": "E", "Rank": "Rnk", "Final": "Score"}


def accumulated(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, name, club, age_group, results): tables of one apparatus each, whose heading names
    it, put together by athlete, club and age group; results maps Result_<apparatus>_<part>
    to its value. One combining aggregation; an athlete's map holds what one page says."""
    rows = table_rows(pages, key, html).filter("header is not null")
    at = lambda *names: F.try_element_at(F.filter(F.arrays_zip("header", "cells"), lambda x: F.lower(x["header"]).isin(*names)), F.lit(1))["cells"]
    app = F.replace("title", F.lit(" "), F.lit("_"))
    parts = F.create_map(*[F.lit(x) for kv in _PARTS.items() for x in kv])
    info = F.lower(F.col("x.header")).isin("name", "athlete", "competitor", "club", "team", "org", "prov", "province", "level", "#", "age", "age group", "age_group", "qual") | F.col("x.header").contains("Unnamed")
    part = F.when(F.col("x.header") == F.col("title"), "Score").otherwise(F.coalesce(F.try_element_at(parts, F.col("x.header")), F.regexp_replace("x.header", "[^a-zA-Z0-9]+", "_")))
    named = rows.select(key, "age_group", "title", app.alias("app"), at("name", "athlete", "competitor").alias("name"), F.coalesce(at("club"), at("team", "org", "province", "prov"), F.lit("")).alias("club"), F.explode(F.arrays_zip("header", "cells")).alias("x"))
    named = named.filter(~F.lower("name").isin("", "name", "nan", "athlete") & ~info & (F.col("x.cells") != ""))
    one = named.select(key, "name", "club", F.coalesce(F.nullif("age_group", F.lit("")), F.lit("N/A")).alias("age_group"), F.concat(F.lit("Result_"), "app", F.lit("_"), part).alias("column"), F.col("x.cells").alias("value"))
    single = one.groupBy(key, "name", "club", "age_group", "column").agg(F.max("value").alias("value"))
    return single.groupBy(key, "name", "club", "age_group").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "value")))).alias("results"))


def _two_levels(tables: list[_Table]) -> Iterator[tuple]:
    for t in tables:
        codes = [re.sub(r"^\./|\.png$", "", x) for x in t.images] or [f"App{i}" for i in range(1, 7)]
        for cells, below in zip(t.rows, t.floats):
            if len(cells) < 4:
                continue
            texts, more = [_plain(c.text) for c in cells], [_plain(c.text) for c in below]
            rank = re.match(r"(\d+)\s*-\s*", texts[2])
            name = _plain(cells[2].anchor) or texts[2]
            club = _plain(cells[2].last) if _plain(cells[2].last) != texts[2] else ""
            parts = {}
            for i, code in enumerate(codes):
                if 4 + i >= len(texts) - 1:
                    break
                parts[f"{code}_Total"] = texts[4 + i]
                for j, part in enumerate(("D", "E", "Bonus", "ND")):
                    parts[f"{code}_{part}"] = more[4 * i + j] if 4 * i + j < len(more) else ""
            yield texts[0], texts[1], rank[1] if rank else "", name, club, texts[3], texts[-1], list(parts.items())


def two_level_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, place, country, athlete_rank, name, club, year, aa_score, results) of pages whose rows
    hold totals and are followed by loose cells, four to an apparatus (named by its
    image in the header): D, E, bonus and deduction."""
    schema = "place string, country string, athlete_rank string, name string, club string, year string, aa_score string, parts array<struct<k:string,v:string>>"
    rows = _parsed(pages, key, html, _two_levels, schema)
    return rows.select(key, "place", "country", "athlete_rank", "name", "club", "year", "aa_score", F.map_from_entries("parts").alias("results"))


def links(pages: DataFrame, key: str, html: str, pattern: str = r"id_prop=(\d+)") -> DataFrame:
    """(meet_id, key, year): each id that a page's links name, with the first page that does, and
    the first year in the row of the link (the text up to the next row), if any."""
    rows = pages.select(key, F.explode(F.split(html, "(?i)<tr[ >]")).alias("row"))
    found = rows.select(key, F.explode(F.regexp_extract_all("row", F.lit(pattern), F.lit(1))).alias("meet_id"), F.nullif(F.regexp_extract(F.regexp_replace("row", "<[^>]*>", " "), r"\b(20\d{2})\b", 1), F.lit("")).alias("year"))
    return found.groupBy("meet_id").agg(F.min(key).alias(key), F.min_by("year", F.when(F.col("year").isNotNull(), F.struct(key, "year"))).alias("year"))


def containers(pages: DataFrame, html: str) -> DataFrame:
    """(meet_id, state, filter, name, dates) of the meet containers of discovery pages; meets of
    other sports are left out."""
    parts = F.posexplode(F.split(html, r"(?=<[a-z]+[^>]*\bdata-meetid=)")).alias("i", "p")
    grab = lambda pattern: F.nullif(F.trim(F.regexp_extract("p", pattern, 1)), F.lit(""))
    out = pages.select(parts).filter(F.col("p").contains("data-meetid=")).select(
        grab(r'data-meetid="([^"]*)"').alias("meet_id"), grab(r'data-state="([^"]*)"').alias("state"), grab(r'data-filter-by="([^"]*)"').alias("filter"),
        grab(r"(?s)<h3[^>]*>(.*?)</h3>").alias("name"), grab(r'(?s)class="meet-dates"[^>]*>(.*?)<').alias("dates"),
    )
    other = F.exists(F.array(*[F.lit("(?i)" + p) for p in config.OTHER_SPORT]), lambda p: F.rlike(F.coalesce("name", F.lit("")), p))
    return out.filter(~other)
