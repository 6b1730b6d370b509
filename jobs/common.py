"""What both jobs share: configuration, command line, paths and logs. Files are reached through Spark only."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("jobs")

#: The partition of rows without a language; Spark's own name for it would read as null.
UNKNOWN = "und"


def read_config(spark: SparkSession, path: str) -> dict[str, Any]:
    """A small JSON file, in any store that Spark reads."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def language(column: str) -> Any:
    """The language as a partition: null and empty together."""
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(UNKNOWN))


def ensured(spark: SparkSession, path: str, schema: str, *by: str) -> None:
    """An empty table where there is none yet, so that the first run reads like any other."""
    spark.createDataFrame([], schema).write.mode("append").partitionBy(*by).parquet(path)


def logged(what: str, rows: DataFrame) -> list[dict[str, Any]]:
    """The rows of a small report, in the log and returned."""
    out = [r.asDict() for r in rows.collect()]
    for r in out:
        log.info("%s: %s", what, ", ".join(f"{k}={v}" for k, v in r.items()))
    return out


def main(run: Callable[..., Any], name: str, paths: list[str], argv: list[str] | None = None) -> int:
    """The command line: a configuration, and paths that may be given instead of those in it."""
    parser = argparse.ArgumentParser(description=run.__doc__)
    parser.add_argument("--config", required=True, help="JSON file with the parameters of the job")
    for p in paths:
        parser.add_argument(f"--{p}", help="instead of the path in the configuration")
    args = vars(parser.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        settings = read_config(spark, args.pop("config"))
        run(spark, **(settings | {k: v for k, v in args.items() if v is not None}))
    finally:
        spark.stop()
    return 0
