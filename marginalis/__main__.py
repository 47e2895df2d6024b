"""Command line: ``python -m marginalis folder|tables --help``."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from .plans.folder import process_folder
from .sources import files, records
from .sources.store import Store


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="marginalis", description="Review annotations on PySpark.")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("folder", help="process what is new in a folder of documents")
    run.add_argument("folder")
    run.add_argument("--store", required=True, help="folder of the state store")
    run.add_argument("--config", help="JSON file with settings")
    run.add_argument("--master", required=True, help="JSON index of the reference edition")
    run.add_argument("--pattern", default="*.pdf")
    run.add_argument("--dry-run", action="store_true")
    show = commands.add_parser("tables", help="count the rows of the store's tables")
    show.add_argument("--store", required=True)
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("marginalis").getOrCreate()
    store = Store(spark, given.store)
    if given.command == "tables":
        from .schemas import TABLES

        print(json.dumps({name: store.read(name).count() for name in TABLES}))
        return 0
    config = records.load_config(given.config)
    now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    done = process_folder(store, given.folder, files.pdf_extractor, config, records.master_index(spark, given.master), now, dry_run=given.dry_run, historical=records.historical_authors(spark, config["historical_authors"]) if config.get("historical_authors") else None, pattern=given.pattern)
    print(json.dumps({"files_seen": done.files_seen, "dry_run": done.dry_run, "results": done.results}, ensure_ascii=False))
    return int(any(r["action"] == "ERROR" for r in done.results))


if __name__ == "__main__":
    raise SystemExit(main())
