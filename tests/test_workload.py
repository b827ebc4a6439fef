"""The inputs of the registered queries."""

from __future__ import annotations

import glob
import os

from tests.helpers import plan_of
from workload.inputs import Inputs
from workload.observations import host_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_events_of_one_row_group_are_dealt_out(spark):
    plan = plan_of(host_rows(spark, SF_DIR))
    assert "REPARTITION_BY_COL" in plan
    # neither the pattern of an address nor its site is evaluated per event
    assert plan.count("regexp_extract(url") <= 2


def test_deliveries_are_compressed_and_lines_written_once(spark):
    given = Inputs(spark, SF_DIR)
    parts = glob.glob(f"{given.ledger_folder}/raw/*/part-*")
    assert parts and all(p.endswith(".lz4") for p in parts)
    arrays = spark.read.text(given.raw_array_lines_path)
    assert arrays.count() == given.hosts.filter("event_id % 500 = 7 AND copy_no = 1").count()
    assert arrays.filter("value NOT LIKE '[%'").count() == 0
