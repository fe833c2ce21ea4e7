"""``python -m tariffa --input FOLDER --output FOLDER --run all``"""

from __future__ import annotations

import argparse
import os

from tariffa.plans.workflow import PHASES, STEPS, Workflow, run
from tariffa.session import build_session, drop_tables
from tariffa.sources.tables import read_csv_folder, read_parquet_folder


def main() -> None:
    parser = argparse.ArgumentParser(prog="tariffa", description="Rate and monitor order-item exposures.")
    parser.add_argument("--list", action="store_true", help="list steps and phases")
    parser.add_argument("--input", help="folder with the six input tables")
    parser.add_argument("--input-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--output", help="folder for the result tables")
    parser.add_argument("--table-format", choices=["csv", "parquet"], default="parquet", help="format of result tables")
    parser.add_argument("--run", choices=[*PHASES, *STEPS], help="step or phase to run")
    args = parser.parse_args()
    if args.list or not args.run:
        for name in STEPS:
            print(name)
        for name, steps in PHASES.items():
            print(f"{name}: {', '.join(steps)}")
        return
    if not args.input or not args.output:
        parser.error("--run needs --input and --output")
    spark = build_session(work=os.path.join(args.output, "_work"))
    read = read_csv_folder if args.input_format == "csv" else read_parquet_folder
    run(Workflow(read(spark, args.input), args.output, table_format=args.table_format), args.run)
    drop_tables(spark)
    spark.stop()


if __name__ == "__main__":
    main()
