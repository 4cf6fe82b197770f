"""Registry of workload queries and their SQL counterparts."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def name_storage(spark: SparkSession) -> None:
    """Give a session of one machine that names no folder a temporary one; a cluster must name its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or not context.master.startswith("local"):
        return
    if not context.master.startswith("local-cluster"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fieldprep-"))


def query(sql: str | None = None):
    """Register a function under its own name, optionally with equivalent SQL."""

    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, d: str) -> DataFrame:
            name_storage(spark)
            return fn(spark, d)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    """Import every workload module so that its queries are registered."""
    from fieldprep.workload import (  # noqa: F401
        aggregates,
        canonical,
        clocks,
        inspections,
        lookups,
        recoding,
        reshaping,
        spatial,
        storage,
        strings,
    )
