"""Run a job specification: `spark-submit … rowferry/__main__.py spec.json`, or `python -m rowferry spec.json`."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from rowferry.plans import JobsFailed, report, run_jobs


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rowferry", description=__doc__)
    parser.add_argument("spec", help="path of a specification, or its JSON text")
    parser.add_argument("--history", help="folder to which rows about the run and its jobs are appended")
    given = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName("rowferry").getOrCreate()
    try:
        results, code = run_jobs(spark, given.spec, given.history), 0
    except JobsFailed as failure:
        results, code = failure.results, 1
    report(spark, results).show(n=len(results), truncate=False, vertical=True)
    return code


if __name__ == "__main__":
    sys.exit(main())
