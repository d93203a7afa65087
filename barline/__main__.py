"""Run the chain from the command line, for example with ``spark-submit --py-files``.

python -m barline ingest PAYLOADS RAW_CSV [--rejected FOLDER]
python -m barline clean RAW_CSV CLEAN_CSV [--files N] [--rejected FOLDER] [--start DAY] [--end DAY]
python -m barline build RAW_CSV NAMESPACE [--location FOLDER] [--rejected FOLDER]
python -m barline store RAW_CSV FOLDER [--since DAY] [--rejected FOLDER]
python -m barline sql TEXT NAMESPACE [--location FOLDER]
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from barline.plans.pipeline import build_files, clean_files, ingest_files, open_layers, store_files
from barline.session import build_session
from barline.sources.tables import run_sql


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="barline")
    commands = parser.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest", help="turn JSON payloads into CSV bars")
    ingest.add_argument("source", help="Parquet files with columns symbol and payload")
    ingest.add_argument("target", help="folder to replace")
    ingest.add_argument("--rejected", help="folder for the symbols and reasons of what was not used")
    clean = commands.add_parser("clean", help="clean raw CSV bars into CSV")
    clean.add_argument("source", help="path or pattern of raw CSV files")
    clean.add_argument("target", help="folder to replace")
    clean.add_argument("--files", type=int, help="number of files to write")
    build = commands.add_parser("build", help="rebuild all layers from raw CSV bars")
    build.add_argument("source", help="path or pattern of raw CSV files")
    by_year = commands.add_parser("store", help="store bars, metrics and summary states by year")
    by_year.add_argument("source", help="path or pattern of raw CSV files")
    by_year.add_argument("root", help="folder of the store")
    by_year.add_argument("--since", type=date.fromisoformat, help="first day of the files: replace the stored days from it on")
    query = commands.add_parser("sql", help="print the result of a query over stored layers")
    query.add_argument("text", help="SQL over NAMESPACE_landing.bars and the other layers")
    for command in (ingest, clean):
        command.add_argument("--start", type=date.fromisoformat, help="first day to keep")
        command.add_argument("--end", type=date.fromisoformat, help="last day to keep")
    for command in (clean, build, by_year):
        command.add_argument("--rejected", help="folder for the values that cannot be read")
    for command in (build, query):
        command.add_argument("namespace", help="prefix of the layer databases")
        command.add_argument("--location", help="folder of the layer databases")
    options = parser.parse_args(arguments)

    logging.basicConfig(format="%(levelname)s %(message)s")
    spark = build_session()
    if options.command == "ingest":
        days = options.start, options.end
        return 0 if ingest_files(spark, options.source, options.target, options.rejected, *days) else 1
    if options.command == "clean":
        days = options.start, options.end
        return 0 if clean_files(spark, options.source, options.target, options.files, options.rejected, *days) else 1
    if options.command == "store":
        made = store_files(spark, options.source, options.root, options.rejected, options.since)
        print(f"commit {made.number} of {options.root}")
        return 0
    if options.command == "sql":
        open_layers(spark, options.namespace, options.location)
        run_sql(spark, options.text).show(100, truncate=False)
        return 0
    layers = build_files(spark, options.source, options.namespace, options.location, options.rejected)
    print(f"loaded {layers.loaded_rows} rows; signals in {layers.signals}, summary in {layers.summary}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
