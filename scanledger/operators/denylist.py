"""Domains checked against a denylist that is a table of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanledger.config import ResolveRules


def suffix_chain(name: Column) -> Column:
    """The name and all names above it: a.b.c, b.c, c."""
    labels = F.split(name, r"\.")
    count = F.size(labels)
    return F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, k, count - k + 1), "."))


def denied_names(names: DataFrame, denylist: DataFrame, suffix: bool = True) -> DataFrame:
    """Those of the distinct ``name`` that are listed or, with ``suffix``, below a listed one.

    ``denylist`` has one column ``domain``. A name is expanded to its few
    suffixes, so the join is on equality and neither side is held whole.
    """
    listed = denylist.select(F.lower("domain").alias("entry")).distinct()
    entries = suffix_chain(F.col("name")) if suffix else F.array("name")
    chain = names.select("name", F.explode(entries).alias("entry"))
    return chain.join(listed, "entry", "left_semi").select("name").distinct()


def with_candidate_domain(
    hosts: DataFrame, denylist: DataFrame, suffix: bool = True, rules: ResolveRules = ResolveRules()
) -> DataFrame:
    """Hosts with ``candidate_domain``: the first of ``domains`` that survives.

    The rule is that of ``functions.resolve.candidate_domain``, which has the
    list in its code and so can't hold a long one. The choice is made once for
    each distinct list of domains and joined back; hosts without domains stay
    out of that join.
    """
    known = F.size("domains") > 0
    lists = hosts.filter(known).select("domains").distinct()
    named = lists.select("domains", F.posexplode("domains").alias("place", "domain")).withColumn(
        "name", F.lower("domain")
    )
    usable = named.filter(
        ~F.col("name").endswith(rules.reserved_suffix)
        & F.instr("name", ".").between(F.lit(1), F.length("name") - 1)
    )
    denied = denied_names(usable.select("name").distinct(), denylist, suffix)
    chosen = (
        usable.join(denied, "name", "left_anti")
        .groupBy("domains")
        .agg(F.min_by("domain", "place").alias("candidate_domain"))
    )
    plain = hosts.drop("candidate_domain")
    without = plain.filter(F.coalesce(~known, F.lit(True))).withColumn("candidate_domain", F.lit(None).cast("string"))
    return plain.filter(known).join(chosen, "domains", "left").select(*without.columns).unionByName(without)
