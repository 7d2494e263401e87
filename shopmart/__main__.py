"""Run the jobs: python -m shopmart STEP --warehouse DIR [options]"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from shopmart.plans import jobs
from shopmart.session import build_session
from shopmart.sources.lookups import read_dictionary, read_holidays
from shopmart.sources.registry import monthly_registry, parse_registry
from shopmart.sources.tables import Tables

STEPS = ("load", "map", "insert", "marts")


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shopmart", description=__doc__)
    parser.add_argument("step", choices=[*STEPS, "all"])
    parser.add_argument("--warehouse", required=True, help="root folder of the stored tables")
    parser.add_argument("--landing", help="folder of the monthly files, for the default registry")
    parser.add_argument("--registry", help="JSON text of a dataset registry")
    parser.add_argument("--dictionary", help="CSV or Parquet with brand and category_index")
    parser.add_argument("--holidays", help="CSV or Parquet with holiday, start_date, end_date and date")
    options = parser.parse_args(argv)
    steps = STEPS if options.step == "all" else (options.step,)
    if "load" in steps and not (options.landing or options.registry):
        parser.error("loading needs --landing or --registry")
    if "map" in steps and not options.dictionary:
        parser.error("mapping needs --dictionary")
    if "marts" in steps and not options.holidays:
        parser.error("marts need --holidays")
    options.steps = steps
    return options


def main(argv: Sequence[str] | None = None) -> None:
    options = arguments(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session()
    tables = Tables(spark, options.warehouse)
    if "load" in options.steps:
        registry = parse_registry(options.registry) if options.registry else monthly_registry(options.landing)
        jobs.load_all(tables, registry)
    if "map" in options.steps:
        jobs.map_brands(tables, read_dictionary(spark, options.dictionary))
    if "insert" in options.steps:
        jobs.expand_mapping(tables)
        jobs.insert_cleaned(tables)
    if "marts" in options.steps:
        jobs.build_marts(tables, read_holidays(spark, options.holidays))


if __name__ == "__main__":
    main()
