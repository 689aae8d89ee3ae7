"""``spark-submit … rollcall INPUT OUTPUT --jobs AuthorCount,Authorship``"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rollcall.plans.suite import (
    DEFAULT_BINS,
    DEFAULT_CATEGORIES,
    DEFAULT_TOP,
    DEFAULT_YEAR_RANGES,
    JOB_NAMES,
    Settings,
    run_jobs,
)
from rollcall.sources.xml_records import DEFAULT_KINDS


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rollcall", description=__doc__)
    parser.add_argument("input", help="XML file, directory or glob")
    parser.add_argument("output", help="output folder; (jobName) stands for the job's folder")
    parser.add_argument("--jobs", default=",".join(JOB_NAMES))
    parser.add_argument("--categories", default=DEFAULT_CATEGORIES)
    parser.add_argument("--bins", default=DEFAULT_BINS)
    parser.add_argument("--year-ranges", default=DEFAULT_YEAR_RANGES)
    parser.add_argument("--top", type=int, default=DEFAULT_TOP)
    parser.add_argument("--on-bad", default="quarantine", choices=["quarantine", "salvage", "drop", "fail"])
    parser.add_argument("--kinds", default=",".join(DEFAULT_KINDS), help="record kinds, comma separated")
    parser.add_argument("--member", default=Settings.member, help="element that holds a member")
    parser.add_argument("--year", default=Settings.year, help="element that holds the year")
    parser.add_argument("--scan", action="append", default=[], metavar="NAME=VALUE", help="further option of the record scan")
    parser.add_argument("--overwrite", action="store_true")
    given = parser.parse_args(arguments)
    settings = Settings(
        categories=given.categories,
        bins=given.bins,
        year_ranges=given.year_ranges,
        top=given.top,
        kinds=tuple(kind.strip() for kind in given.kinds.split(",")),
        member=given.member,
        year=given.year,
        on_bad=given.on_bad,
        scan=dict(item.split("=", 1) for item in given.scan),
    )
    spark = SparkSession.builder.appName("rollcall").getOrCreate()
    mode = "overwrite" if given.overwrite else "error"
    reports = run_jobs(spark, given.input, given.output, given.jobs, settings, mode=mode)
    for name, folder in reports.items():
        print(f"{name}: {folder}")


if __name__ == "__main__":
    main()
