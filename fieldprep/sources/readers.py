"""Readers. Raw tables come as text columns; types are given later, by rule.

Delimited text may have line breaks inside quotes, so a file is read by one task: splitting it would
cut records. One file holds one year; convert large ones to Parquet once and read that.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldprep.functions.geometry import RINGS_TYPE
from fieldprep.operators.columns import repair_duplicate_names
from fieldprep.operators.reshape import union_by_name
from fieldprep.operators.spatial import BOX, within_window

# Fixed value: names of the yearly extract files.
EXTRACT_PATTERN = r"metabase_[0-9]+"
FIRST_EXTRACT_YEAR = 2020

#: Delimited text as it is written by hand: quotes doubled inside quotes, line breaks, padded cells.
CSV = {
    "quote": '"',
    "escape": '"',
    "multiLine": True,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "inferSchema": False,
}
#: Extracts and options say NA for a missing cell; the other tables keep the text.
MISSING = {"nullValue": "NA"}


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_titled_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV file whose first line is a title and whose second line is the header; all columns text.

    Only those two lines come to the driver. Repeated headers get a position suffix. Title and header
    go by position: a record may say what the header says. An empty cell is NULL.
    """
    lines = [row.value for row in spark.read.text(path).head(2)]
    if len(lines) < 2:
        raise ValueError(f"no header line in {path}")
    header = next(csv.reader([lines[1]]))
    names = repair_duplicate_names(header)
    df = spark.read.schema(text_schema(names)).options(header=True, **CSV).csv(path)
    if len(df.inputFiles()) != 1:
        raise ValueError(f"expected one file: {path}")
    # The title goes as the header of the reader. The file is one partition, whose rows count from 0.
    at = F.monotonically_increasing_id().bitwiseAND(2**33 - 1)
    return df.withColumn("__at", at).filter("__at > 0").drop("__at")


def empty_to_missing(df: DataFrame) -> DataFrame:
    """Empty cells as NULL, which a reader with another word for missing leaves as empty texts."""
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_year_tables(spark: SparkSession, paths: Mapping[int, str], fmt: str = "titled_csv") -> dict[int, DataFrame]:
    """One text table per year, keyed by year."""
    if fmt == "titled_csv":
        return {year: read_titled_csv(spark, path) for year, path in paths.items()}
    return {year: as_text(spark.read.format(fmt).load(path)) for year, path in paths.items()}


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths of the files in a folder whose name matches, sorted by name.

    Spark's own file listing, so any storage Spark reads will do; only paths are fetched.
    """
    found = spark.read.format("binaryFile").load(folder).select("path")
    names = [row.path for row in found.collect()]
    return sorted((p for p in names if re.search(pattern, p.rsplit("/", 1)[-1])), key=lambda p: p.rsplit("/", 1)[-1])


def read_extracts(
    spark: SparkSession,
    folder: str,
    pattern: str = EXTRACT_PATTERN,
    first_year: int = FIRST_EXTRACT_YEAR,
    fmt: str = "csv",
) -> DataFrame:
    """All matching extracts as one text table with a ``Year`` by position in the sorted listing.

    Each file is read with its own header and unioned by name: one read over files with
    differing headers would align them by position.
    """
    paths = list_files(spark, folder, pattern)
    if not paths:
        raise ValueError(f"no file like {pattern} in {folder}")

    def one(path: str, year: int) -> DataFrame:
        if fmt == "csv":
            df = empty_to_missing(spark.read.options(header=True, **CSV, **MISSING).csv(path))
        else:
            df = as_text(spark.read.format(fmt).load(path))
        return df.withColumn("Year", F.lit(year))

    return union_by_name([one(p, first_year + i) for i, p in enumerate(paths)])


def read_lookup(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A lookup table, text columns."""
    if fmt == "csv":
        return spark.read.options(header=True, **CSV).csv(path)
    return as_text(spark.read.format(fmt).load(path))


def read_key_list(
    spark: SparkSession, path: str, fmt: str = "titled_csv"
) -> DataFrame:
    """A hand-kept list of keys, one file per year."""
    return read_titled_csv(spark, path) if fmt == "titled_csv" else read_lookup(spark, path, fmt)


def read_points(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_parts(
    spark: SparkSession,
    path: str,
    attributes: Mapping[str, str],
    fmt: str = "parquet",
    window: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Polygon parts: attribute columns and a ring array; of a layer stored with boxes those in a window."""
    boxes = [f"{c} double" for c in BOX] if window else []
    schema = ", ".join([*(f"`{n}` {t}" for n, t in attributes.items()), f"rings {RINGS_TYPE}", *boxes])
    parts = spark.read.schema(schema).format(fmt).load(path)
    return within_window(parts, *window).drop(*BOX) if window else parts


def table_or_read(df: DataFrame | None, read) -> DataFrame:
    """The caller's table if given, else the stored one."""
    return read() if df is None else df


@dataclass(frozen=True)
class Options:
    """Paths and report year: a one-row options table."""

    base_dir: str
    operations_folder: str
    year: int
    spatial_folder: str
    figure_folder: str
    figure_output_folder: str


def read_options(spark: SparkSession, path: str | None, headers: Mapping[str, str] | None = None) -> Options:
    """Read the options; ``headers`` names the column of a field where it differs from the field."""
    if not path:
        raise ValueError("no path to the options table given")
    rows = empty_to_missing(spark.read.options(header=True, **CSV, **MISSING).csv(path)).head(2)
    if len(rows) != 1:
        raise ValueError("the options table must have exactly one row")
    values = rows[0].asDict()
    named = {f.name: values.get((headers or {}).get(f.name, f.name)) for f in fields(Options)}
    missing = [name for name, value in named.items() if value is None]
    if missing:
        raise ValueError(f"options missing: {missing}")
    return Options(**{**named, "year": int(named["year"])})
