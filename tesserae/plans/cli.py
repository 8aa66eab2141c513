"""Command line: run the pipeline, or one of its stages, infer from saved artefacts, or check result files."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tesserae.operators.validate import validate_files
from tesserae.plans.config import Config
from tesserae.plans.pipeline import STAGES, Run, call, infer, run
from tesserae.sources.files import find_data


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("command", choices=["run", "infer", "stage", "validate"])
    parser.add_argument("--data-dir", required=True, action="append", help="may be repeated: the first that holds the data counts")
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--stage", choices=[name for name, _ in STAGES])
    parser.add_argument("--debug-sample", type=int)
    parser.add_argument("--check-ids", action="store_true")
    given = parser.parse_args(arguments)
    if given.command == "stage" and not given.stage:
        parser.error("stage needs --stage")
    spark = SparkSession.builder.getOrCreate()
    data = given.data_dir[0] if len(given.data_dir) == 1 else find_data(spark, given.data_dir)
    config = Config(debug_rows=given.debug_sample)
    config.configure_logging()
    errors, warnings = [], []
    if given.command in ("run", "infer"):
        errors, warnings = (run if given.command == "run" else infer)(spark, data, given.output_dir, config)
    elif given.command == "stage":
        found = call(Run(spark, data, given.output_dir, config), [given.stage])
        if given.stage == "results":
            errors, warnings = found
    else:
        whole = Run(spark, data, given.output_dir, config)
        source = lambda n: whole.raw("test", n).select("entity_id")
        valid = source(2).unionByName(source(3)) if given.check_ids else None
        errors, warnings = validate_files(spark, f"{given.output_dir}/matching_results.tsv", source(1), f"{given.output_dir}/candidate_pairs.tsv", valid)
    for line in warnings:
        print("WARNING:", line)
    for line in errors:
        print("ERROR:", line)
    return int(bool(errors))


if __name__ == "__main__":
    sys.exit(main())
