"""The whole run from an options table, each stage only when something it reads has changed.

The options name folders; what lies in them has fixed names:

- ``base_dir``: one titled table per year (``2015.csv``), the extracts (``metabase_1.csv`` and so on, or
  one stored table ``extracts`` with a Year);
- ``operations_folder``: lookups and gazetteer, and below ``fouled`` one list of keys per year;
- ``spatial_folder``: the layers of regions, stations and waterbodies;
- ``figure_output_folder``: what the run stores.

A stage is known by what it reads: paths, sizes and times of its files, the report year, and the stage
before it. That is noted when the stage has ended, so a run that stops on the way begins there again,
and a run without any change writes nothing.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldprep.plans.combining import FIRST_LISTED_YEAR, LAST_TABLE_YEAR, fouled_keys
from fieldprep.plans.fixed_values import FOULED_LIST_ROWS
from fieldprep.plans.run import (
    Layers,
    Lookups,
    Sources,
    make_polygon_summaries,
    make_reports,
    prepare_inspections,
    stored_waterbodies,
)
from fieldprep.sources import readers
from fieldprep.sources.versions import children, filesystem

MANIFEST = "_manifest"
FIRST_TABLE_YEAR = 2015
STAGES = ("prepare", "reports", "polygons")
PREPARING = ("corrections", "craft_types", "craft_categories", "abbreviations")
REPORTING = ("states", "stations", "regions")
WATERS = ("lakes", "rivers", "manmade")


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, size and time of every file below a path, sorted; nothing is read."""
    where, files = filesystem(spark, path)
    if not files.exists(where):
        raise ValueError(f"no input at {path}")
    found, out = files.listFiles(where, True), []
    while found.hasNext():
        status = found.next()
        out.append((status.getPath().toUri().getPath(), int(status.getLen()), int(status.getModificationTime())))
    return sorted(out)


def _noted(spark: SparkSession, path: str) -> str | None:
    where, files = filesystem(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text


def _note(spark: SparkSession, path: str, text: str) -> None:
    where, files = filesystem(spark, path)
    stream = files.create(where, True)
    stream.write(bytearray(text.encode()))
    stream.close()


class Inputs:
    """The tables of a run as the options place them; ``fmt`` is "csv", or that of tables stored by Spark."""

    def __init__(self, spark: SparkSession, options: readers.Options, fmt: str = "csv"):
        self.spark, self.options, self.fmt = spark, options, fmt
        self.ending = ".csv" if fmt == "csv" else ""

    def _below(self, folder: str, name: str) -> str:
        return f"{folder.rstrip('/')}/{name}{self.ending}"

    def lookup_path(self, name: str) -> str:
        return self._below(self.options.operations_folder, name)

    def layer_path(self, name: str) -> str:
        return f"{self.options.spatial_folder.rstrip('/')}/{name}"

    def year_paths(self) -> dict[int, str]:
        return {y: self._below(self.options.base_dir, str(y)) for y in range(FIRST_TABLE_YEAR, LAST_TABLE_YEAR + 1)}

    def list_paths(self) -> dict[int, str]:
        folder = f"{self.options.operations_folder.rstrip('/')}/fouled"
        years = [n.removesuffix(self.ending) for n in children(self.spark, folder)]
        return {int(y): self._below(folder, y) for y in years if y.isdigit()}

    def extracts_path(self) -> str:
        base = self.options.base_dir.rstrip("/")
        return base if self.fmt == "csv" else f"{base}/extracts"

    def _table(self, path: str) -> DataFrame:
        return readers.read_lookup(self.spark, path) if self.fmt == "csv" else self.spark.read.format(self.fmt).load(path)

    def sources(self) -> Sources:
        titled = "titled_csv" if self.fmt == "csv" else self.fmt
        lists = {y: readers.read_key_list(self.spark, p, titled) for y, p in self.list_paths().items()}
        early = {y: df for y, df in lists.items() if FIRST_LISTED_YEAR <= y <= LAST_TABLE_YEAR}
        late = {y: df for y, df in lists.items() if y > LAST_TABLE_YEAR}
        if self.fmt == "csv":
            extracts = readers.read_extracts(self.spark, self.extracts_path())
        else:
            extracts = self._table(self.extracts_path()).withColumn("Year", F.col("Year").cast("int"))
        recent = fouled_keys(late, {y: n for y, n in FOULED_LIST_ROWS.items() if "position" in late.get(y, extracts).columns})
        return Sources(readers.read_year_tables(self.spark, self.year_paths(), titled), extracts, early, recent)

    def lookups(self) -> Lookups:
        places = self._table(self.lookup_path("gazetteer"))
        places = places.withColumns({c: F.col(c).cast("double") for c in ("lon", "lat")})
        return Lookups(*[self._table(self.lookup_path(n)) for n in PREPARING], places)

    def layers(self) -> Layers:
        read = lambda name: self.spark.read.parquet(self.layer_path(name))
        # The merged layer is made anew whenever this stage runs.
        waters = stored_waterbodies(self.spark, *map(read, WATERS), self.options.figure_output_folder, refresh=True)
        return Layers(*map(read, REPORTING), waters)


def run_from_options(
    spark: SparkSession, path: str | None, headers: Mapping[str, str] | None = None, fmt: str = "csv", full_repair: bool = False
) -> dict[str, bool]:
    """Run what has changed; says of each stage whether it ran. Missing options or inputs are refused."""
    options = readers.read_options(spark, path, headers)
    given, out = Inputs(spark, options, fmt), options.figure_output_folder.rstrip("/")
    read = {
        "prepare": [*given.year_paths().values(), given.extracts_path(), *given.list_paths().values(), *map(given.lookup_path, PREPARING)],
        "reports": [given.lookup_path("gazetteer"), *map(given.layer_path, REPORTING)],
        "polygons": [given.lookup_path("gazetteer"), *map(given.layer_path, WATERS)],
    }
    run: dict[str, Callable[[], object]] = {
        "prepare": lambda: prepare_inspections(spark, given.sources(), given.lookups(), out, full_repair),
        "reports": lambda: make_reports(spark, given.lookups(), _without_waters(given), out, options.year),
        "polygons": lambda: make_polygon_summaries(spark, given.lookups(), given.layers(), out, options.year),
    }
    ran, before = {}, ""
    for stage in STAGES:
        told = [listing(spark, p) for p in read[stage]]
        what = [before, full_repair if stage == "prepare" else options.year, told]
        before = hashlib.sha256(json.dumps(what).encode()).hexdigest()
        note = f"{out}/{MANIFEST}/{stage}"
        ran[stage] = _noted(spark, note) != before
        if ran[stage]:
            run[stage]()
            _note(spark, note, before)
    return ran


def _without_waters(given: Inputs) -> Layers:
    """The layers that reports read."""
    return Layers(*[given.spark.read.parquet(given.layer_path(n)) for n in REPORTING], None)
