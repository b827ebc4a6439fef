"""Columns that turn one observation into a company key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanledger import config
from scanledger.config import ResolveRules
from scanledger.functions.common import any_of, contains_any


def candidate_domain(domains: Column, rules: ResolveRules = ResolveRules()) -> Column:
    """First domain that is neither denied, nor a reserved zone, nor a bare label.

    The domain keeps its case and a trailing dot; NULL when none survives.
    """

    def usable(domain: Column) -> Column:
        name = F.lower(domain)
        return (
            ~name.isin(*rules.denied_domains)
            & ~name.endswith(rules.reserved_suffix)
            # A dot before the last character: a trailing dot alone does not count.
            & F.instr(name, ".").between(F.lit(1), F.length(name) - 1)
        )

    return F.when(F.size(domains) > 0, F.get(F.filter(domains, usable), F.lit(0)))


def dynamic_ptr_flag(hostnames: Column) -> Column:
    """First hostname looks like an address-pool entry; no hostname gives false."""
    first = F.get(hostnames, F.lit(0))
    return F.when(
        F.size(hostnames) > 0,
        first.rlike(config.DASHED_IP_PATTERN)
        | first.rlike(config.DOTTED_IP_PATTERN)
        | F.lower(first).rlike(config.CUSTOMER_MARKER_PATTERN),
    ).otherwise(False)


def carrier_text(org: Column, isp: Column) -> Column:
    """Organisation and carrier names on two lines, so one search covers both."""
    return F.lower(F.concat_ws("\n", org, isp))


def hyperscaler_flag(org: Column, isp: Column, rules: ResolveRules = ResolveRules()) -> Column:
    return contains_any(carrier_text(org, isp), rules.hyperscaler_keywords)


def generic_isp_flag(org: Column, rules: ResolveRules = ResolveRules()) -> Column:
    return contains_any(F.coalesce(F.lower(org), F.lit("")), rules.generic_isp_keywords)


def domain_allowed(dynamic: Column, hyperscaler: Column) -> Column:
    """The domain may name the company; unknown when the PTR flag is."""
    return ~dynamic & ~hyperscaler


def org_allowed(org: Column, hyperscaler: Column, generic: Column) -> Column:
    """The organisation may name the company."""
    return org.isNotNull() & ~hyperscaler & ~generic


def resolution_tier(candidate: Column, by_domain: Column, by_org: Column) -> Column:
    """``domain``, ``org`` or ``unresolved``; an unknown condition does not hold."""
    return (
        F.when(candidate.isNotNull() & by_domain, "domain")
        .when(by_org, "org")
        .otherwise("unresolved")
    )


def org_key(org: Column) -> Column:
    """Lower-cased name without surrounding spaces and trailing punctuation."""
    trimmed = F.trim(org, F.lit(config.UNICODE_SPACES))
    return F.rtrim(F.lower(trimmed), F.lit(config.ORG_TRAILING_NOISE))


def company_key(tier: Column, candidate: Column, org: Column) -> Column:
    return F.when(tier == "domain", F.lower(candidate)).when(tier == "org", org_key(org))


def is_denied_domain(
    domain: Column, suffix: bool = True, rules: ResolveRules = ResolveRules()
) -> Column:
    """Domain belongs to a hosting provider: equal to, or (suffix) below, a listed one."""
    name = F.coalesce(F.lower(domain), F.lit(""))
    exact = name.isin(*rules.infra_domains)
    if not suffix:
        return exact
    return exact | any_of(name.endswith("." + d) for d in rules.infra_domains)
