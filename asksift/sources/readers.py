"""Query logs, rating tables and stage tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import normalize_text
from .stages import require_columns, shared_folder, stage

# Cell texts that spreadsheet readers take for an empty cell.
EMPTY_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

#: A list of files beyond that is not broadcast, and the bits of an ordinal that
#: number the rows of a file.
LISTING_BYTES = 32 << 20
ROW_BITS = 40


def drop_null_texts(df: DataFrame, text: str = "Query") -> DataFrame:
    """Rows without a text go; blank texts stay."""
    return df.na.drop(subset=[text])


def prepare_log(df: DataFrame, text: str = "Query") -> DataFrame:
    """Check, drop null texts, normalise. Other columns pass through."""
    require_columns(df, text)
    return drop_null_texts(df, text).withColumn(text, normalize_text(F.col(text)))


def _scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str,
    schema: T.StructType | str | None,
    options: dict[str, str],
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def natural_key(path: Column) -> Column:
    """A text that sorts paths by folder and name with numbers as numbers, so
    that ``part-100000`` follows ``part-99999``."""
    runs = F.regexp_extract_all(path, F.lit(r"(\d+|\D+)"), F.lit(1))
    digits = F.lit(40)
    padded = F.transform(
        runs, lambda r: F.when(r.rlike(r"^\d"), F.lpad(r, F.greatest(F.length(r), digits), "0")).otherwise(r)
    )
    return F.array_join(padded, "")


def natural_order(path: str) -> tuple[str, str]:
    """The same order for a path on the driver; equal keys go by the path."""
    return re.sub(r"[0-9]+", lambda run: run.group().rjust(40, "0"), path), path


def _plain(path: str) -> str:
    """A path as the scan writes it in its rows: the list of files has an empty
    authority, the rows have none."""
    return path.replace(":///", ":/")


def with_file_order(df: DataFrame, fmt: str) -> DataFrame:
    """Add ``ordinal``, a number that follows file name and row order.

    The scan's own list of files, sorted with numbers as numbers, gives each file a
    rank, which is broadcast. For parquet the ordinal is a long: the rank, then the
    row's number in its file. Other formats know only where a row's split starts and
    an id that increases along the split: rank, start and id make a decimal of fixed
    width, and the log is landed as a stage table, which fixes those ids and spares
    later passes the parsing. A list beyond ``LISTING_BYTES`` is not broadcast: then
    every row carries its path's sort key in a struct instead.
    """
    listing = sorted({_plain(p) for p in df.inputFiles()}, key=natural_order)
    if sum(map(len, listing)) > LISTING_BYTES or len(listing) >= 1 << (63 - ROW_BITS):
        return _with_carried_order(df, fmt)
    parquet = fmt == "parquet"
    start = F.lit(0).cast("long") if parquet else F.col("_metadata.file_block_start")
    row = F.col("_metadata.row_index") if parquet else F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    path = F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/"))
    ranks = df.sparkSession.createDataFrame(list(enumerate(listing)), "__rank long, __path string")
    placed = df.select("*", path.alias("__path"), start.alias("__start"), row.alias("__row"))
    placed = placed.join(F.broadcast(ranks), "__path", "left")
    unknown = F.raise_error(F.concat(F.lit("not in the list of files: "), "__path")).cast("long")
    rank = F.coalesce("__rank", unknown)
    if parquet:
        ordinal = F.shiftleft(rank, ROW_BITS) + F.col("__row")
        return placed.select(*df.columns, ordinal.alias("ordinal"))
    digits = [rank.cast("string"), F.lpad(F.col("__start").cast("string"), 15, "0"), F.lpad(F.col("__row").cast("string"), 10, "0")]
    placed = placed.select(*df.columns, F.concat(*digits).cast("decimal(38,0)").alias("ordinal"))
    return stage(placed, shared_folder(df.sparkSession))


def _with_carried_order(df: DataFrame, fmt: str) -> DataFrame:
    """The same as a struct that each row carries whole."""
    zero = F.lit(0).cast("long")
    if fmt == "parquet":
        start, row = zero, F.col("_metadata.row_index")
    else:
        start, row = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    path = F.col("_metadata.file_path")
    ordinal = F.struct(
        natural_key(path).alias("file"), path.alias("path"), start.alias("start"), row.alias("row")
    )
    placed = df.select("*", ordinal.alias("ordinal"))
    return placed if fmt == "parquet" else stage(placed, shared_folder(df.sparkSession))


def read_log(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    text: str = "Query",
    ordinal: str | None = None,
    empty_cells: list[str] | None = None,
    **options: str,
) -> DataFrame:
    """Read a query log: ``ordinal``, the normalised text, and all other columns.

    ``ordinal`` names a column that gives the row order; without one the order
    in the files counts. ``empty_cells`` lists texts to be read
    as null, as a spreadsheet reader would (``EMPTY_CELLS``).
    """
    raw = require_columns(_scan(spark, path, fmt, schema, options), text)
    if empty_cells:
        raw = raw.withColumn(
            text, F.when(~F.col(text).cast("string").isin(empty_cells), F.col(text))
        )
    if ordinal is None:
        ordered = with_file_order(raw, fmt)
    else:
        ordered = require_columns(raw, ordinal).withColumnRenamed(ordinal, "ordinal")
    return prepare_log(ordered, text)


def to_numeric(df: DataFrame, columns: list[str], kind: str = "int") -> DataFrame:
    """Cells to whole numbers: ``1.0`` is 1, TRUE and FALSE are 1 and 0, blank
    cells and those of ``EMPTY_CELLS`` are null. Any other cell is an error."""

    def number(name: str) -> Column:
        cell = F.trim(F.col(name).cast("string"))
        whole = cell.try_cast("double")
        return (
            F.when(cell.isNull() | cell.isin(EMPTY_CELLS), F.lit(None))
            .when(F.upper(cell).isin("TRUE", "T"), F.lit(1))
            .when(F.upper(cell).isin("FALSE", "F"), F.lit(0))
            .when(whole == F.floor(whole), whole)
            .otherwise(F.raise_error(F.concat(F.lit(f"no whole number in {name}: "), cell)).cast("double"))
            .cast(kind)
        )

    return df.select(*[number(c).alias(c) for c in columns])


def read_ratings(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Read a rating table: raters in columns, one case per row.

    A row with fewer cells than the header has null ratings at its end. A row with
    more is an error that shows it, as its ratings may belong to other raters;
    separators without a cell behind them do no harm.
    """
    options = {"sep": sep, "header": True}
    names = spark.read.options(**options).csv(path).columns
    odd = "__odd"
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, odd]])
    # A row that does not fit the header is kept as text, if no column is left out.
    whole = options | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": odd, "columnPruning": False}
    raw = spark.read.options(**whole).schema(schema).csv(path)
    quoted = F.regexp_replace(odd, r'"(?:[^"]|"")*"', "x")
    bare = F.regexp_replace(quoted, f"(?:{re.escape(sep)}\\s*)+$", "")
    surplus = F.size(F.split(bare, re.escape(sep))) > len(names)
    error = F.raise_error(F.concat(F.lit(f"more than {len(names)} cells: "), odd)).cast("string")
    # Every column checks its row, so that the check runs whichever is read.
    fits = {n: F.when(surplus, error).otherwise(F.col(n)) for n in names}
    return to_numeric(raw.withColumns(fits), names)
