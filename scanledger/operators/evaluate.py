"""Evaluation metrics, samples for labelling and call costs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.config import DECISION_LABELS, CostRules
from scanledger.functions.common import round_half_up
from scanledger.schemas import COMPANY_KEY


def eval_metrics(
    pairs: DataFrame, run_keys: Sequence[str] = (), labels: Sequence[str] = DECISION_LABELS
) -> DataFrame:
    """Per label: tp, fp, fn, precision, recall and f1, with the overall accuracy.

    ``pairs`` has ``predicted`` and ``expected``; ``run_keys`` tell evaluation
    runs apart. Pairs are counted first, so each label sees only the distinct
    (predicted, expected) combinations.
    """
    counted = pairs.groupBy(*run_keys, "predicted", "expected").agg(F.count("*").alias("n"))
    per_label = counted.select(
        "*", F.explode(F.array(*[F.lit(x) for x in labels])).alias("label")
    )
    n, label = F.col("n"), F.col("label")
    said, right = F.col("predicted").eqNullSafe(label), F.col("expected").eqNullSafe(label)

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    figures = per_label.groupBy(*run_keys, "label").agg(
        total(said & right).alias("tp"),
        total(said & ~right).alias("fp"),
        total(~said & right).alias("fn"),
        F.try_divide(
            total(F.col("predicted").eqNullSafe(F.col("expected"))), F.sum(n)
        ).alias("overall_accuracy"),
    )
    p, r = F.col("precision"), F.col("recall")
    return figures.withColumns(
        {
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
        }
    ).withColumn(
        "f1", F.when((p > 0) & (r > 0), F.lit(2.0) * p * r / (p + r))
    )


def eval_report(
    pairs: DataFrame, run_keys: Sequence[str] = ("prompt_version", "run_no"),
    rules: CostRules = CostRules(),
) -> DataFrame:
    """The metrics of each run with its model, number of examples and total cost.

    ``pairs`` has one row per example: predicted, expected, model and the tokens
    of its call. One row per run and label; the run's own figures are repeated.
    """
    costs = with_call_cost(pairs, rules).groupBy(*run_keys).agg(
        F.max("model").alias("model"),
        F.count("*").alias("n_examples"),
        round_half_up(F.sum(_exact("cost_usd", 6)).cast("double"), 4).alias("total_cost_usd"),
    )
    return eval_metrics(pairs, run_keys).join(costs, list(run_keys))


def run_accuracy(report: DataFrame) -> DataFrame:
    """One row per run of a report: what ``eval_delta`` compares."""
    return report.select("prompt_version", "run_no", "overall_accuracy").distinct()


def eval_delta(runs: DataFrame, order: str = "run_no") -> DataFrame:
    """Accuracy of each run minus that of the previous run of its prompt version."""
    previous = F.lag("overall_accuracy").over(
        Window.partitionBy("prompt_version").orderBy(order)
    )
    return runs.withColumn("previous_accuracy", previous).withColumn(
        "accuracy_delta", F.col("overall_accuracy") - F.col("previous_accuracy")
    )


def sampling_key(seed: int) -> Column:
    """Pseudo-random order of accounts that a retried task reproduces."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *COMPANY_KEY))


def random_sample(accounts: DataFrame, size: int, seed: int = 0) -> DataFrame:
    """``size`` accounts in pseudo-random order; repeatable for a seed."""
    return accounts.orderBy(sampling_key(seed), *COMPANY_KEY).limit(size)


def stratified_sample(
    accounts: DataFrame, per_bucket: int = 4, seed: int = 0,
    low: int = 50, high: int = 84, width: int = 5,
) -> DataFrame:
    """``per_bucket`` accounts of each score bucket of the review range.

    The rank filter also runs before the shuffle, so a bucket sends only a few
    rows per task however many accounts it holds.
    """
    in_range = accounts.filter(F.col("contact_score").between(low, high))
    bucketed = in_range.withColumn(
        "bucket", F.floor((F.col("contact_score") - low) / width).cast("bigint")
    )
    order = Window.partitionBy("bucket").orderBy(sampling_key(seed), *COMPANY_KEY)
    return (
        bucketed.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= per_bucket)
        .drop("_rank")
    )


def _rate(model: Column, position: int, rules: CostRules) -> Column:
    entries = [F.lit(x) for name, rates in rules.prices.items() for x in (name, rates[position])]
    return F.coalesce(F.try_element_at(F.create_map(*entries), model), F.lit(0.0))


def call_cost(
    model: Column, input_tokens: Column, output_tokens: Column, rules: CostRules = CostRules()
) -> Column:
    """USD of one call, to a millionth; an unknown model costs nothing."""
    spent = input_tokens * _rate(model, 0, rules) + output_tokens * _rate(model, 1, rules)
    return round_half_up(spent / F.lit(1_000_000.0), 6)


def with_call_cost(traces: DataFrame, rules: CostRules = CostRules()) -> DataFrame:
    return traces.withColumn(
        "cost_usd",
        call_cost(F.col("model"), F.col("input_tokens"), F.col("output_tokens"), rules),
    )


def _exact(column: str, digits: int) -> Column:
    """Decimal copy of a rounded double: sums do not depend on row order."""
    return F.col(column).cast(f"decimal(18,{digits})")


def trace_summary(
    traces: DataFrame, by: Sequence[str] = ("skill", "prompt_version", "model")
) -> DataFrame:
    """Calls, tokens, mean latency and cost per skill, prompt version and model."""
    latency = F.sum(_exact("latency_ms", 1)).cast("double") / F.count("latency_ms")
    return traces.groupBy(*by).agg(
        F.count("*").alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        round_half_up(latency, 1).alias("avg_latency_ms"),
        F.sum(_exact("cost_usd", 6)).cast("double").alias("total_cost_usd"),
    )


def cost_projection(accounts: DataFrame, rules: CostRules = CostRules()) -> DataFrame:
    """Calls and cost of one full pass over the review band, against the ceiling."""
    review, total = F.count_if(F.col("band") == "review"), F.count("*")
    return accounts.agg(
        total.alias("accounts"),
        review.alias("review_accounts"),
        round_half_up(F.try_divide(total - review, total) * F.lit(100.0), 1).alias(
            "rule_decided_pct"
        ),
        round_half_up(review * F.lit(rules.cost_per_call), 4).alias("projected_cost_usd"),
        F.lit(rules.ceiling).alias("ceiling_usd"),
        (review * F.lit(rules.cost_per_call) <= rules.ceiling).alias("within_ceiling"),
    )
