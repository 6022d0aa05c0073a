"""Writing results: tables, CSV, SQL text, reports, and the ledger of files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import sql_literal
from ..runtime import file_system


def replace_table(df: DataFrame, path: str) -> None:
    """Drop and recreate: an overwrite of the folder, atomic by job commit."""
    df.write.mode("overwrite").parquet(path)


def append_new(df: DataFrame, path: str, key: list[str]) -> None:
    """Append the rows whose key isn't there yet (insert or ignore)."""
    old = df.sparkSession.read.parquet(path).select(*key)
    if not key:
        raise ValueError("append_new needs a key")
    first = df.withColumn("__n", F.row_number().over(W.partitionBy(*key).orderBy(*[c for c in df.columns if c not in key] or key))).filter("__n = 1").drop("__n")
    first.join(old, key, "left_anti").write.mode("append").parquet(path)


def swap_table(df: DataFrame, path: str, expected: int) -> None:
    """Replace a table by a new version of exactly the expected rows.

    The new version is written beside the table and counted; only if it is right do two
    renames put it in place. A refused version is deleted and the table stays as it is.
    """
    spark = df.sparkSession
    beside, old = f"{path}__new", f"{path}__old"
    fs, target = file_system(spark, path)
    new, gone = file_system(spark, beside)[1], file_system(spark, old)[1]
    if not fs.exists(target) and fs.exists(gone):  # a swap that was cut off between its renames
        fs.rename(gone, target)
    df.write.mode("overwrite").parquet(beside)
    n = spark.read.parquet(beside).count()
    if n != expected:
        fs.delete(new, True)
        raise ValueError(f"{path}: the new version has {n} rows, {expected} expected")
    fs.delete(gone, True)
    if fs.exists(target):
        fs.rename(target, gone)
    fs.rename(new, target)
    fs.delete(gone, True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def insert_statements(df: DataFrame, table: str, bare: tuple[str, ...] = ()) -> DataFrame:
    """(statement): an INSERT per row that does nothing on conflict; columns in ``bare`` are
    numbers and stay unquoted."""
    names = ", ".join(f'"{c}"' for c in df.columns)
    values = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) if c in bare else sql_literal(F.col(c)) for c in df.columns])
    return df.select(F.concat(F.lit(f'INSERT INTO "{table}" ({names}) VALUES ('), values, F.lit(") ON CONFLICT DO NOTHING;")).alias("statement"))


def export_rows(df: DataFrame, numbers: tuple[str, ...], keys: list[str], order: list[str]) -> DataFrame:
    """Rows for export: number columns as numbers (blank and unreadable ones null), of rows
    with equal keys as text the first."""
    typed = df.withColumns({c: F.trim(c).try_cast("double") for c in numbers})
    k = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    return typed.withColumn("__n", F.row_number().over(W.partitionBy(*k).orderBy(*order))).filter("__n = 1").drop("__n")


def ledger(old: DataFrame, new: DataFrame) -> DataFrame:
    """(file_path, file_hash, last_processed): the latest entry of each path."""
    cols = ["file_path", "file_hash", "last_processed"]
    both = old.select(*cols).unionByName(new.select(*cols))
    return both.groupBy("file_path").agg(F.max_by("file_hash", F.struct("last_processed", "file_hash")).alias("file_hash"), F.max("last_processed").alias("last_processed"))


def unprocessed(files: DataFrame, done: DataFrame) -> DataFrame:
    """Files whose content the ledger doesn't know."""
    return files.join(done.select("file_hash").distinct(), "file_hash", "left_anti")


def error_rows(df: DataFrame, message: str, most: int = 500) -> DataFrame:
    """Error records with messages cut to ``most`` characters."""
    return df.withColumn(message, F.substring(message, 1, most))


def markdown(df: DataFrame, title: str, most: int) -> str:
    """A report of the first ``most`` rows; bars in cells become dashes."""
    rows = df.limit(most).collect()
    clean = lambda x: "" if x is None else str(x).replace("|", "-")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(clean(x) for x in r) + " |" for r in rows]) + "\n"


def sent_in_chunks(rows: DataFrame, delete_all: Callable[[], None], send: Callable[[list[dict]], None], size: int = 100) -> int:
    """Replace a remote table: what is there is deleted, then the rows are sent in chunks. The
    transport (with its address and credentials) is the caller's; what it raises ends the
    run there. Rows pass through the driver a partition at a time, for small exports."""
    delete_all()
    sent, chunk = 0, []
    for row in rows.toLocalIterator():
        chunk.append(row.asDict(recursive=True))
        if len(chunk) == size:
            send(chunk)
            sent, chunk = sent + len(chunk), []
    if chunk:
        send(chunk)
    return sent + len(chunk)
