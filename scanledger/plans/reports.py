"""The reports that are read after a build, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from scanledger.operators import evaluate, quality, serving
from scanledger.plans.build import Layers


def quality_reports(
    layers: Layers, raw: DataFrame | None = None, counts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Null, distinct, flag and coverage figures, yields and distributions.

    The layers are reconciled by the ``counts`` observed while they were
    written, or else, and if ``raw`` has line counts of the export, by counting
    them.
    """
    if counts is not None and raw is None:
        reconciled = quality.reconcile_observed(counts, layers.hosts, layers.companies, layers.signals)
    else:
        reconciled = quality.layer_reconcile(
            layers.hosts, layers.keyed, layers.host_map, layers.companies, layers.signals,
            layers.accounts, raw,
        )
    return {
        "null_rates": quality.null_rates(layers.hosts),
        "distinct_counts": quality.distinct_counts(layers.hosts),
        "flag_rates": quality.flag_rates(layers.hosts),
        "coverage": quality.coverage(layers.hosts),
        "top_orgs": quality.top_orgs(layers.hosts),
        "resolution_yield": quality.resolution_yield(layers.keyed),
        "unresolved_orgs": quality.unresolved_orgs(layers.keyed),
        "infra_concentration": quality.infra_concentration(layers.companies),
        "top_urgency": quality.top_urgency(layers.signals),
        "top_cve_companies": quality.top_cve_companies(layers.signals),
        "signal_prevalence": quality.signal_prevalence(layers.signals),
        "band_distribution": quality.band_distribution(layers.accounts),
        "top_accounts": serving.top_accounts(layers.accounts),
        "review_sample": evaluate.random_sample(
            layers.accounts.filter("band = 'review'"), size=5
        ),
        "cost_projection": evaluate.cost_projection(layers.accounts),
        "layer_reconcile": reconciled,
    }
