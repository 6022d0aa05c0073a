"""Reading result files, manifests, alias tables, logs and file contents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..operators.badrows import with_cells
from ..operators.reshape import header_row, two_row_headers, without_index
from ..runtime import broadcast_if_small, materialize


def lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, line_no, line): every line that isn't empty, counted from 1 within its file.

    Files are split where they are large. Within a split, lines are numbered in their order;
    the counts of the splits before it are added, so no file is held by one task. Lines
    that aren't UTF-8 are read as Latin-1; a byte order mark is taken off.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    raw = F.col("value").cast("binary")
    text = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.decode(raw, "ISO-8859-1"))
    at = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"), text.alias("line"))
    blocks = at.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
    before = blocks.select("file", "block", (F.sum("n").over(W.partitionBy("file").orderBy("block")) - F.col("n")).alias("before"))  # a row per split
    here = F.row_number().over(W.partitionBy("file", "block").orderBy("i"))
    each = at.withColumn("here", here).join(before, ["file", "block"]).select("file", (F.col("before") + F.col("here")).cast("int").alias("line_no"), F.regexp_replace("line", "^\ufeff", "").alias("line"))
    return each.filter("line != ''")


def records(text: DataFrame, header_words: tuple[str, ...] = ("name",), within: int = 10, together: bool = False) -> DataFrame:
    """(file, row, fields) of CSV lines (file, line_no, line) of any header: fields is an array
    of (pos, header, value), all text, blanks null.

    The header is the first of the leading lines that has a cell containing one of the
    words (``together``: cells equal to all of them), in any case, else the first
    line. Cells beyond the header and repeats of the header line are left out. The
    headers, one row per file, are written first, so that their size is known: where they
    are small, rows meet them where they are read, and lines of a few large files aren't
    shuffled to as few tasks. A row's cells are never shuffled apart.
    """
    rows = with_cells(text.select("file", "line_no", "line"), "line").select("file", "line_no", "cells")
    rows = rows.withColumn("trimmed", F.transform("cells", F.trim))
    low = F.transform("trimmed", F.lower)
    words = F.array(*[F.lit(w) for w in header_words])
    hit = F.forall(words, lambda w: F.array_contains(low, w)) if together else F.exists(low, lambda c: F.exists(words, lambda w: c.contains(w)))
    rows = rows.withColumn("hit", hit & (F.col("line_no") <= within))
    early = F.struct("line_no", F.col("trimmed").alias("headers"))
    head = rows.groupBy("file").agg(F.min(F.when(F.col("hit"), early)).alias("named"), F.min(early).alias("first"))
    head = materialize(head.select("file", F.coalesce("named", "first").alias("h")))
    body = rows.join(broadcast_if_small(head), "file").filter((F.col("line_no") > F.col("h.line_no")) & (F.col("trimmed") != F.col("h.headers")))
    # zipped, as a lambda that refers to a column of the other side of the join is pushed down wrongly
    both = F.zip_with(F.col("h.headers"), F.col("cells"), lambda h, c: F.struct(h.alias("header"), F.nullif(F.trim(c), F.lit("")).alias("value")))
    pairs = F.transform(F.filter(both, lambda x: x["header"].isNotNull()), lambda x, i: F.struct(i.alias("pos"), x["header"].alias("header"), x["value"].alias("value")))
    return body.select("file", F.col("line_no").alias("row"), pairs.alias("fields"))


def melted(text: DataFrame, header_words: tuple[str, ...] = ("name",), within: int = 10) -> DataFrame:
    """(file, row, pos, header, value): the cells of ``records``, those that are there."""
    each = records(text, header_words, within).select("file", "row", F.explode("fields").alias("x")).select("file", "row", "x.*")
    return each.select("file", "row", "pos", "header", "value")


def melted_csv(spark: SparkSession, path: str, glob: str | None = None, header_words: tuple[str, ...] = ("name",), within: int = 10) -> DataFrame:
    """``melted`` over the files of a folder."""
    return melted(lines(spark, path, glob), header_words, within)


def file_headers(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(file, header, rows): the first line of each file and how many follow."""
    return lines(spark, path, glob).groupBy("file").agg(F.min_by("line", "line_no").alias("header"), (F.count(F.lit(1)) - 1).alias("rows"))


def header_census(headers: DataFrame) -> DataFrame:
    """(header, files, rows): how often each form of header occurs."""
    return headers.groupBy("header").agg(F.countDistinct("file").alias("files"), F.sum("rows").alias("rows"))


def wide_csv(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """CSV files of one header, all text, blanks null, with columns ``file`` and ``row``."""
    m = melted_csv(spark, path, glob)
    names = [r.header for r in m.groupBy("header").agg(F.min("pos").alias("p")).orderBy("p", "header").collect()]  # one header
    return m.groupBy("file", "row").agg(*[F.max(F.when(F.col("header") == n, F.col("value"))).alias(n) for n in names])


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(meet_id, name, start_date_iso, location, year) of a manifest of any source."""
    m = melted_csv(spark, path, header_words=("meetid",))
    pick = lambda *hs: F.coalesce(*[F.max(F.when(F.lower("header") == h, F.col("value"))) for h in hs])
    g = m.groupBy("file", "row").agg(
        pick("meetid").alias("meet_id"), pick("meetname", "name").alias("name"), pick("start_date_iso", "dates", "date").alias("start_date_iso"), pick("location", "state").alias("location"), pick("year").alias("y")
    )
    return g.filter("meet_id is not null").select("meet_id", "name", "start_date_iso", "location", F.col("y").try_cast("double").cast("int").cast("string").alias("year"))


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, canonical, pos) of a JSON object of texts, in the order of the file; no rows
    without the file."""
    try:
        raw = spark.read.text(path, wholetext=True)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "alias string, canonical string, pos int")
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    return raw.select(F.posexplode(entries).alias("pos", "e")).select(F.col("e.key").alias("alias"), F.col("e.value").alias("canonical"), "pos")


def failures(spark: SparkSession, path: str) -> DataFrame:
    """(file, meet_id) of each line of a log that tells of a failure."""
    found = F.regexp_extract("value", r"\[FAIL\] ([^\s:]+):", 1)
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), found.alias("meet_id")).filter("meet_id != ''")


def report_gaps(text: DataFrame) -> DataFrame:
    """(meet_name, level, ghost) of a free-text audit report, as lines (file, line_no, line).

    Lines of the section ``--- 3. Ghost Entries`` that name the source are ghosts (the meet
    is what stands between the source and two blanks); in all sections, lines of the
    form ``[source] Meet (Lvl X): Missing`` are gaps of one level. Sections are found
    by the last heading before a line, whose number is one row per file.
    """
    heads = text.filter(F.col("line").startswith("---"))
    start = heads.filter(F.col("line").startswith("--- 3. Ghost Entries")).groupBy("file").agg(F.min("line_no").alias("start"))
    ghosts = text.join(start, "file").filter("line_no > start").select(F.trim(F.regexp_extract("line", r"livemeet\s+(.*?)\s{2,}", 1)).alias("meet_name"), F.lit(None).cast("string").alias("level"), F.lit(True).alias("ghost"))
    gap = r"\[livemeet\] (.*?) \(Lvl (.*?)\): Missing"
    gaps = text.select(F.trim(F.regexp_extract("line", gap, 1)).alias("meet_name"), F.trim(F.regexp_extract("line", gap, 2)).alias("level"), F.lit(False).alias("ghost"))
    return ghosts.unionByName(gaps).filter("meet_name != ''").distinct()


@pandas_udf(T.StructType([T.StructField("at", T.LongType()), T.StructField("data", T.LongType()), T.StructField("header", T.ArrayType(T.StringType()))]))
def _messy_header(leading: pd.Series) -> pd.Series:
    """Where the header of some leading rows stands, the first row of data, and the header:
    two rows made one where the second names parts of results."""
    out = []
    for rows in leading:
        ordered = sorted(rows, key=lambda r: r["line_no"])
        cells = [[c or "" for c in r["cells"]] for r in ordered]
        at = header_row(cells)
        at = 0 if at < 0 else at
        two = at + 1 < len(cells) and any(c.strip() in ("D", "Score", "Rnk") for c in cells[at + 1])
        header = two_row_headers(cells[at], cells[at + 1]) if two else two_row_headers(cells[at], [])
        keep = set(without_index(cells[at]))
        last = ordered[at + 1 if two else at]["line_no"]
        out.append((ordered[at]["line_no"], last, [h if i in keep else "" for i, h in enumerate(header)]))
    return pd.DataFrame(out, columns=["at", "data", "header"])


def messy_records(text: DataFrame, within: int = 10) -> DataFrame:
    """(file, row, fields) of lines whose header is one or two of the leading rows: found by a
    cell that says name, athlete, gymnast or competitor; two rows are merged where the
    second names D, Score or Rnk; an index column is dropped. What stands above the
    header is no data. At most ``within`` lines a file are looked at for the header."""
    rows = with_cells(text.select("file", "line_no", "line"), "line").select("file", "line_no", "cells")
    lead = rows.filter(F.col("line_no") <= within).groupBy("file").agg(F.collect_list(F.struct("line_no", "cells")).alias("lead"))
    head = lead.select("file", _messy_header("lead").alias("h"))
    body = rows.join(head, "file").filter("line_no > h.data")
    both = F.zip_with(F.col("h.header"), F.col("cells"), lambda h, c: F.struct(h.alias("header"), F.nullif(F.trim(c), F.lit("")).alias("value")))
    pairs = F.transform(both, lambda x, i: F.struct(i.alias("pos"), x["header"].alias("header"), x["value"].alias("value")))
    return body.select("file", F.col("line_no").alias("row"), F.filter(pairs, lambda x: F.coalesce(x["header"], F.lit("")) != "").alias("fields"))


def renamed_fields(rows: DataFrame, names: dict[str, str], mark: str, final: str) -> DataFrame:
    """``rows`` (file, row, fields) with headers renamed and the mark in the file's name replaced."""
    new = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    fields = F.transform("fields", lambda x: x.withField("header", F.coalesce(F.try_element_at(new, x["header"]), x["header"])))
    return rows.select(F.replace("file", F.lit(mark), F.lit(final)).alias("file"), "row", fields.alias("fields"))


def targets(spark: SparkSession, path: str) -> DataFrame:
    """(name): the distinct lines of a text file, trimmed, blanks left out."""
    return spark.read.text(path).select(F.trim("value").alias("name")).filter("name != ''").distinct()


def padded_rows(text: DataFrame, columns: list[str]) -> DataFrame:
    """Ragged lines as rows of exactly these columns: missing cells are null, and what is
    beyond them belongs to the last, commas included. Of lines with one first cell the
    first in the file is kept; the header line is none."""
    cells = F.split("line", ",", len(columns))
    at = lambda i: F.nullif(F.trim(F.try_element_at(cells, F.lit(i + 1))), F.lit(""))
    rows = text.select("file", "line_no", *[at(i).alias(c) for i, c in enumerate(columns)]).filter(F.col(columns[0]).isNotNull() & (F.col(columns[0]) != columns[0]))
    first = rows.groupBy(columns[0]).agg(F.min(F.struct("file", "line_no", *columns[1:])).alias("x"))
    return first.select(columns[0], *[F.col(f"x.{c}").alias(c) for c in columns[1:]])


def dumped_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of an SQL dump: the literals of each INSERT, by the given columns; NULL is null."""
    values = F.regexp_extract("value", r"(?i)^\s*INSERT INTO .*? VALUES\s*\((.*)\)[^)]*$", 1)
    items = F.regexp_extract_all(values, F.lit(r"('(?:[^']|'')*'|[^,\s][^,]*)"), F.lit(1))
    text = lambda i: F.trim(F.try_element_at(items, F.lit(i + 1)))
    bare = lambda x: F.when(F.upper(x) == "NULL", None).when(x.startswith("'"), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit("''"), F.lit("'"))).otherwise(x)
    return spark.read.text(path).filter(values != "").select(*[bare(text(i)).alias(c) for i, c in enumerate(columns)])


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(file, file_hash, length) by content, hashed where the files are read."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return b.select(F.col("path").alias("file"), F.md5("content").alias("file_hash"), "length")


def status(spark: SparkSession, path: str, wholetext: bool = True) -> DataFrame:
    """(source, meet_id, status, fail_count) of a status file whose values are texts or objects:
    one JSON object (``wholetext``), or one a line."""
    raw = spark.read.text(path, wholetext=wholetext)
    e = raw.select(F.explode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("e"))
    v = F.col("e.value")
    key = F.split(F.col("e.key"), "_", 2)
    return e.select(key[0].alias("source"), F.try_element_at(key, F.lit(2)).alias("meet_id"), F.coalesce(F.get_json_object(v, "$.status"), v).alias("status"), F.coalesce(F.get_json_object(v, "$.fail_count").cast("int"), F.lit(0)).alias("fail_count"))
