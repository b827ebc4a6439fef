"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanledger.operators.accounts import filter_band, gold_accounts
from scanledger.operators.adjudicate import decision_overlay, rule_adjudicate
from scanledger.operators.resolve import companies_rollup, host_company_map, keyed_table
from scanledger.operators.signals import signals_rollup
from scanledger.plans.build import build, build_from_hosts
from scanledger.plans.ledger import ingest_new
from scanledger.schemas import CONTACT_FIELDS
from scanledger.session import scratch_dir
from scanledger.sources.writers import write_parquet_zstd
from workload import recipes
from workload.observations import host_rows


#: Dates of the exports of ``dated_folder``, and the host columns that differ from the given ones, in
#: SQL that both engines read.
EXPORTS: dict[str, dict[str, str]] = {
    "2024-01-31": {},
    "2024-02-29": {
        "org": "CASE WHEN port = 22 AND country_code = 'US' THEN concat(org, ' Group') ELSE org END",
        "isp": "CASE WHEN port = 80 AND country_code = 'DE' THEN 'Carrier 9' ELSE isp END",
        "is_c2": "CASE WHEN transport = 'udp' AND country_code = 'CN' THEN true ELSE is_c2 END",
        "is_eol_product": "CASE WHEN port = 443 THEN false ELSE is_eol_product END",
    },
}
#: What is changed in the part of an export that is delivered again.
DELIVERED_AGAIN = {"org": "concat(org, ' Group')", "port": "CASE WHEN port = 80 THEN 8080 ELSE port END"}


def with_changes(hosts: DataFrame, changed: dict[str, str]) -> DataFrame:
    types = dict(hosts.dtypes)
    return hosts.withColumns({c: F.expr(value).cast(types[c]) for c, value in changed.items()})


class Inputs:
    """Layers of one set of tables, each written once and then read as a table.

    This is how the layers are used in production: a query reads the table of
    the layer before it. Nothing is written before a query asks for it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run a recipe over the given tables."""
        for name in recipes.TABLES:
            text = text.replace("{" + name + "}", f"parquet.`{self.sf_dir}/{name}.parquet`")
        return self.spark.sql(text)

    @cached_property
    def folder(self) -> str:
        return scratch_dir(self.spark, "layers")

    def _written(self, table: DataFrame, name: str) -> DataFrame:
        return write_parquet_zstd(table, f"{self.folder}/{name}")

    @cached_property
    def hosts(self) -> DataFrame:
        return self._written(host_rows(self.spark, self.sf_dir), "hosts")

    @cached_property
    def keyed(self) -> DataFrame:
        return self._written(keyed_table(self.hosts), "keyed")

    @cached_property
    def host_map(self) -> DataFrame:
        return self._written(host_company_map(self.keyed), "host_company_map")

    @cached_property
    def companies(self) -> DataFrame:
        return self._written(companies_rollup(self.keyed), "companies")

    @cached_property
    def signals(self) -> DataFrame:
        return self._written(signals_rollup(self.keyed, self.host_map), "security_signals")

    @cached_property
    def accounts(self) -> DataFrame:
        return self._written(gold_accounts(self.companies, self.signals), "accounts")

    @cached_property
    def adjudicated(self) -> DataFrame:
        decisions = rule_adjudicate(filter_band(self.accounts, "review"))
        return self._written(decision_overlay(self.accounts, decisions), "accounts_adjudicated")

    @cached_property
    def raw_lines_path(self) -> str:
        """The hosts as raw nested JSON lines, with a broken line now and then."""
        records = self.hosts.select(F.to_json(F.struct(*raw_columns())).alias("value"))
        broken = self.hosts.filter(
            (F.col("event_id") % 100 == 0) & (F.col("copy_no") == 1)
        ).select(F.lit('{"ip_str": "10.0.0.1", "port": ').alias("value"))
        path = f"{self.folder}/raw"
        records.unionByName(broken).write.text(path)
        return path

    @cached_property
    def raw_array_lines_path(self) -> str:
        """Lines that hold an array of records, to be read beside the raw lines."""
        arrays = self.hosts.filter((F.col("event_id") % 500 == 7) & (F.col("copy_no") == 1))
        line = F.lit('[{"ip_str": "10.0.0.2", "port": 80}, {"ip_str": "10.0.0.3"}]')
        path = f"{self.folder}/raw_arrays"
        arrays.select(line.alias("value")).write.text(path)
        return path

    @cached_property
    def raw_gzip_path(self) -> str:
        path = f"{self.folder}/raw_gzip"
        self.spark.read.text(self.raw_lines_path).write.text(path, compression="gzip")
        return path

    @cached_property
    def build_folder(self) -> str:
        """All layers built from the raw lines, with the counts observed meanwhile."""
        folder = scratch_dir(self.spark, "build")
        build(self.spark, self.raw_lines_path, folder)
        return folder

    @cached_property
    def dated_folder(self) -> str:
        """Layers of two dated exports of all observations; some are different in the later one."""
        folder = scratch_dir(self.spark, "dated")
        for date, changed in EXPORTS.items():
            build_from_hosts(with_changes(self.hosts, changed), folder, snapshot_date=date)
        return folder

    @cached_property
    def ledger_folder(self) -> str:
        """All observations as an export in parts: a second run finds a new part and another one changed.

        A third run finds nothing new.
        """
        folder = scratch_dir(self.spark, "ledger")

        def deliver(part: int, changed: dict[str, str]) -> None:
            own = with_changes(self.hosts.filter(F.col("event_id") % 4 == part), changed)
            lines = own.select(F.to_json(F.struct(*raw_columns())).alias("value"))
            lines.write.mode("overwrite").text(f"{folder}/raw/p{part}", compression="lz4")

        for part in (0, 1, 2):
            deliver(part, {})
        parts = f"{folder}/raw/*"
        runs = [ingest_new(self.spark, parts, folder, withdraw_missing=True)]
        deliver(2, DELIVERED_AGAIN)
        deliver(3, {})
        runs += [ingest_new(self.spark, parts, folder, withdraw_missing=True) for _ in range(2)]
        if runs != [1, 2, None]:
            raise AssertionError(f"batches {runs}")
        return folder

    @property
    def hits(self) -> DataFrame:
        return self.sql(recipes.EMAIL_HITS)

    @property
    def contact_records(self) -> DataFrame:
        return self.sql(recipes.CONTACT_RECORDS).select(
            "company_key",
            F.col("contact_score"),
            "country",
            "organization",
            F.when(F.col("has_contact"), F.struct(*CONTACT_FIELDS)).alias("contact"),
            "raw_email_count",
            "seq",
        )

    @property
    def traces(self) -> DataFrame:
        return self.sql(recipes.TRACES)

    @property
    def eval_pairs(self) -> DataFrame:
        return self.sql(recipes.EVAL_PAIRS)

    @property
    def replies(self) -> DataFrame:
        return self.sql(recipes.replies("spark"))


def raw_columns() -> list[Column]:
    """Host columns back in the nested shape of a raw record."""

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    missing = F.lit(None).cast("string")
    return [
        F.col("ip_str"),
        text("port").alias("port"),
        F.col("transport"),
        F.translate(text("ts"), " ", "T").alias("timestamp"),
        F.col("hostnames"),
        F.col("domains"),
        F.struct(
            "country_code", "country_name", "city", missing.alias("region_code"),
            "latitude", "longitude",
        ).alias("location"),
        *[F.col(c) for c in ("org", "isp", "asn", "os", "product", "devicetype", "tags", "cpe23")],
        F.col("vulns"),
        F.struct(F.col("ssl_jarm").alias("jarm")).alias("ssl"),
        F.struct(
            F.col("http_status").alias("status"), F.col("http_server").alias("server"),
            F.col("http_title").alias("title"), missing.alias("host"),
        ).alias("http"),
        F.struct(
            F.col("shodan_module").alias("module"), missing.alias("region"),
            F.lit(True).alias("ptr"),
        ).alias("_shodan"),
        F.struct(
            F.col("screenshot_labels").alias("labels"),
            F.coalesce("screenshot_text", F.lit("")).alias("text"),
        ).alias("screenshot"),
        F.concat(F.lit("payload "), F.col("event_id")).alias("data"),
    ]


_CACHE: dict[tuple, Inputs] = {}


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Inputs of these tables as they are now; changed files give new layers."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ("events", "customer", "nation", "pages")]
    state = (
        spark.read.format("binaryFile")
        .load(paths)
        .agg(F.count("*"), F.sum("length"), F.max("modificationTime"))
        .first()
    )
    key = (spark.sparkContext.applicationId, sf_dir, tuple(state))
    if key not in _CACHE:
        _CACHE[key] = Inputs(spark, sf_dir)
    return _CACHE[key]
