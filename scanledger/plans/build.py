"""Build every layer from a raw export; each layer is a written table.

Resolution and the CVE figures are row-level but costly (keyword and pattern
tests, map functions), and four consumers need them. They are computed once
and written as a narrow table; a lazy chain would push the tier filter below
the projection and repeat those tests.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.config import AdjudicationRules, ResolveRules, ScoreRules, SignalRules
from scanledger.operators.accounts import filter_band, gold_accounts
from scanledger.operators.adjudicate import adjudication_input, decision_overlay, rule_adjudicate
from scanledger.operators.evaluate import random_sample
from scanledger.operators.ingest import flatten_hosts
from scanledger.operators.resolve import companies_rollup, host_company_map, keyed_table
from scanledger.operators.signals import signals_rollup, signals_rollup_direct
from scanledger.schemas import (
    ACCOUNTS, ADJUDICATED, COMPANIES, HOST_COLUMNS, HOST_MAP, HOSTS, KEYED, SIGNALS,
)
from scanledger.sources.readers import REJECTED, scan_raw_records
from scanledger.sources.writers import keep_counts, observed_layer, read_layer, write_jsonl


@dataclass(frozen=True)
class BuildRules:
    resolve: ResolveRules = field(default_factory=ResolveRules)
    signals: SignalRules = field(default_factory=SignalRules)
    scores: ScoreRules = field(default_factory=ScoreRules)
    adjudication: AdjudicationRules = field(default_factory=AdjudicationRules)
    # False counts every resolved row once and skips the hosts/map join, which takes a third of
    # the time. The results are equal if (ip, port, time) is unique and port and time are never NULL.
    join_hosts_to_map: bool = True


@dataclass(frozen=True)
class Layers:
    hosts: DataFrame
    keyed: DataFrame
    host_map: DataFrame
    companies: DataFrame
    signals: DataFrame
    accounts: DataFrame


def host_figures() -> dict[str, Column]:
    """Raw rows, those of lines that are no object, and rows without any value, from the one parse."""
    empty = F.coalesce(*[F.col(c).cast("string") for c in HOST_COLUMNS if c != "vulns"]).isNull()
    return {
        "rows": F.count(F.lit(1)),
        "rejected": F.count_if(F.col(REJECTED)),
        "empty": F.count_if(empty & F.col("vulns").isNull()),
    }


def _figures() -> dict[str, dict[str, Column]]:
    """What is observed of each layer while it is written."""
    rows = F.count(F.lit(1))
    tier, band = F.col("resolution_tier"), F.col("band")
    return {
        HOSTS: host_figures(),
        KEYED: {
            "rows": rows,
            "tiers": F.count_if(tier.isin("domain", "org", "unresolved")),
            "resolved": F.count_if(tier.isin("domain", "org")),
        },
        HOST_MAP: {"rows": rows},
        COMPANIES: {"rows": rows, "hosts": F.sum("host_count")},
        SIGNALS: {"rows": rows},
        ACCOUNTS: {"rows": rows, "banded": F.count_if(band.isin("contact", "review", "skip", "exclude"))},
        ADJUDICATED: {"rows": rows, "labelled": F.count("final_label")},
    }


def ingest(
    spark: SparkSession,
    raw_path: str | list[str],
    out_dir: str,
    snapshot_date: str | None = None,
    array_lines_as_null: bool = False,
) -> DataFrame:
    """Raw export -> hosts table, as one partition per export if it is dated.

    Every input split is parsed by a task of its own. An export shrinks about
    200-fold in the hosts table, so its rows are then rebalanced into files of
    the advisory partition size; otherwise 100 TB would leave 800,000 files of
    half a megabyte. Raw, rejected and written rows are counted on the way.
    """
    raw = scan_raw_records(spark, raw_path, array_lines_as_null, with_rejected=True)
    hosts = flatten_hosts(raw, REJECTED)
    figures = _figures()[HOSTS]
    return observed_layer(hosts, out_dir, HOSTS, figures, snapshot_date, rebalance=True, hidden=(REJECTED,))


def build_from_hosts(
    hosts: DataFrame,
    out_dir: str,
    rules: BuildRules = BuildRules(),
    snapshot_date: str | None = None,
) -> Layers:
    """Hosts of one export -> keyed hosts, map, companies, signals and accounts."""

    figures, counts = _figures(), {}

    def written(table: DataFrame, layer: str) -> DataFrame:
        return observed_layer(table, out_dir, layer, figures[layer], snapshot_date, counts)

    keyed = written(keyed_table(hosts, rules.resolve, rules.signals), KEYED)
    host_map = written(host_company_map(keyed), HOST_MAP)
    companies = written(companies_rollup(keyed, rules.resolve), COMPANIES)
    rollup = (
        signals_rollup(keyed, host_map) if rules.join_hosts_to_map else signals_rollup_direct(keyed)
    )
    signals = written(rollup, SIGNALS)
    accounts = written(gold_accounts(companies, signals, rules.scores), ACCOUNTS)
    keep_counts(hosts.sparkSession, out_dir, counts, snapshot_date)
    return Layers(hosts, keyed, host_map, companies, signals, accounts)


def build(
    spark: SparkSession,
    raw_path: str | list[str],
    out_dir: str,
    rules: BuildRules = BuildRules(),
    snapshot_date: str | None = None,
    array_lines_as_null: bool = False,
) -> Layers:
    hosts = ingest(spark, raw_path, out_dir, snapshot_date, array_lines_as_null)
    return build_from_hosts(hosts, out_dir, rules, snapshot_date)


def review_accounts(layers: Layers, sample: int | None = None) -> DataFrame:
    """The accounts to adjudicate; ``sample`` limits a trial run to that many."""
    review = filter_band(layers.accounts, "review")
    return review if sample is None else random_sample(review, sample)


def export_inputs(layers: Layers, path: str, sample: int | None = None) -> None:
    """Write the inputs of a model that adjudicates, one JSON record per account."""
    write_jsonl(adjudication_input(review_accounts(layers, sample)), path)


def adjudicate(
    layers: Layers,
    out_dir: str,
    decisions: DataFrame | None = None,
    sample: int | None = None,
    rules: BuildRules = BuildRules(),
    snapshot_date: str | None = None,
) -> DataFrame:
    """Overlay decisions (by default those of the written rule) on the accounts.

    ``sample`` limits a trial run to that many review accounts; the others
    keep their band.
    """
    if decisions is None:
        decisions = rule_adjudicate(review_accounts(layers, sample), rules.adjudication)
    overlaid = decision_overlay(layers.accounts, decisions)
    return observed_layer(overlaid, out_dir, ADJUDICATED, _figures()[ADJUDICATED], snapshot_date)


def read_layers(spark: SparkSession, out_dir: str, snapshot_date: str | None = None) -> Layers:
    """The layers of an earlier build; of a dated one, those of one export."""
    return Layers(
        *[
            read_layer(spark, f"{out_dir}/{path}", snapshot_date)
            for path in (HOSTS, KEYED, HOST_MAP, COMPANIES, SIGNALS, ACCOUNTS)
        ]
    )
