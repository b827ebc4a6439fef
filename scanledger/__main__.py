"""Command line: ``spark-submit`` this package's main with one of the commands.

    ingest     raw export -> hosts table
    build      raw export -> all layers
    inputs     write the review accounts as inputs of a model
    adjudicate overlay the decisions of the written rule, or those of a model's replies or traces
    report     print the quality reports
    accounts   list accounts by label, country and score
    account    one company in detail
    update     read the files of an export that were not read yet, as a batch
    clear      remove the intermediate tables of an earlier application
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from scanledger.operators import adjudicate, serving
from scanledger.plans import build, ledger, reports
from scanledger.session import clear_scratch
from scanledger.sources import readers
from scanledger.sources.writers import (
    COUNTS, latest_snapshot, layer_exists, read_counts, read_layer,
)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="scanledger", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--out", required=True, help="folder of the layers")
        sub.add_argument("--snapshot-date", help="date of the export (default: the last one built)")
        return sub

    for name in ("ingest", "build"):
        sub = command(name)
        sub.add_argument("--raw", required=True, nargs="+", help="raw NDJSON files or folders")
        sub.add_argument("--array-lines-as-null", action="store_true", help="slower, see the README")
    export = command("inputs")
    export.add_argument("--to", required=True, help="folder of the JSON records")
    export.add_argument("--sample", type=int, help="review accounts of a trial run")
    overlay = command("adjudicate")
    overlay.add_argument("--sample", type=int, help="review accounts of a trial run")
    given = overlay.add_mutually_exclusive_group()
    given.add_argument("--replies", help="JSON records with company_key, resolution_tier and reply")
    given.add_argument("--traces", help="logged calls of the scoring skill")
    command("report").add_argument("--raw", nargs="+", help="count the lines of the export again")
    listing = command("accounts")
    listing.add_argument("--band")
    listing.add_argument("--country")
    listing.add_argument("--min-score", type=float)
    listing.add_argument("--limit", type=int, default=10)
    command("account").add_argument("--key", required=True)
    growing = command("update")
    growing.add_argument("--raw", required=True, nargs="+", help="raw NDJSON files or folders, all of them")
    growing.add_argument("--withdraw-missing", action="store_true", help="forget files that are gone")
    growing.add_argument("--array-lines-as-null", action="store_true", help="slower, see the README")
    commands.add_parser("clear").add_argument("--application", required=True, help="id of the application")
    return parser


def gold(spark: SparkSession, out: str, snapshot_date: str | None) -> DataFrame:
    """Adjudicated accounts if there are any, else the accounts."""
    adjudicated = f"{out}/gold/accounts_adjudicated"
    if layer_exists(spark, adjudicated):
        table = read_layer(spark, adjudicated, snapshot_date)
        # an export that was built but not adjudicated yet has no rows there
        if snapshot_date is None or table.head(1):
            return readers.gold_view(None, table)
    return readers.gold_view(read_layer(spark, f"{out}/gold/accounts", snapshot_date))


def decisions(spark: SparkSession, given: argparse.Namespace) -> DataFrame | None:
    if given.replies:
        return adjudicate.decisions_from_replies(readers.scan_replies(spark, given.replies))
    if given.traces:
        return adjudicate.decisions_from_traces(readers.scan_traces(spark, given.traces))
    return None


def main(argv: list[str] | None = None) -> None:
    given = arguments().parse_args(argv)
    spark = SparkSession.builder.appName("scanledger").getOrCreate()
    if given.command in ("ingest", "build"):
        run = build.ingest if given.command == "ingest" else build.build
        run(
            spark, given.raw, given.out, snapshot_date=given.snapshot_date,
            array_lines_as_null=given.array_lines_as_null,
        )
        return
    if given.command == "update":
        batch = ledger.ingest_new(
            spark, given.raw, given.out, given.withdraw_missing, given.array_lines_as_null
        )
        print("nothing new" if batch is None else f"batch {batch}")
        return
    if given.command == "clear":
        print("removed" if clear_scratch(spark, given.application) else "nothing to remove")
        return
    date = given.snapshot_date or latest_snapshot(spark, f"{given.out}/gold/accounts")
    if given.command == "inputs":
        build.export_inputs(build.read_layers(spark, given.out, date), given.to, given.sample)
    elif given.command == "adjudicate":
        layers = build.read_layers(spark, given.out, date)
        build.adjudicate(
            layers, given.out, decisions(spark, given), given.sample, snapshot_date=date
        )
    elif given.command == "report":
        raw = readers.line_counts(spark, given.raw) if given.raw else None
        layers = build.read_layers(spark, given.out, date)
        counts = read_counts(spark, given.out, date) if layer_exists(spark, f"{given.out}/{COUNTS}") else None
        for name, table in reports.quality_reports(layers, raw, counts).items():
            rows = table.collect()
            print(name, *table.columns, sep="\t")
            for row in rows:
                print("", *row, sep="\t")
    elif given.command == "accounts":
        serving.query_accounts(
            gold(spark, given.out, date), given.band, given.country, given.min_score, given.limit
        ).show(given.limit, truncate=False)
    else:
        serving.get_account(gold(spark, given.out, date), given.key).show(truncate=False)


if __name__ == "__main__":
    main()
