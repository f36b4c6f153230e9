"""The command-line steps end to end on CSV sources."""

import os

import pytest

from cohortlens.__main__ import main
from cohortlens.sources import fixtures
from cohortlens.sources.tables import Store

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_cli_steps(spark, scratch):
    raw_dir = os.path.join(scratch, "raw")
    raw = fixtures.raw_sources(spark, SF)
    for name, df in raw.items():
        df.coalesce(1).write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(os.path.join(raw_dir, f"{name}.csv"))
    out = os.path.join(scratch, "out")
    assert main(["explore", "--raw", raw_dir, "--out", out]) == 0
    assert main(["build", "--raw", raw_dir, "--out", out, "--user-buckets", "4"]) == 0
    assert main(["test", "--raw", raw_dir, "--out", out]) == 0
    assert main(["train", "--out", out]) == 0
    assert main(["report", "--out", out]) == 0

    def read(group, name):
        return Store(spark, os.path.join(out, group)).read(name)

    assert read("model_output", "model_metrics").count() == 2
    assert read("reports", "factor_table").count() > 0
    assert read("profiles", "journeys").first().users == raw["user_activity"].select("user_id").distinct().count()
    spelled = {r.event_type for r in read("profiles", "revenue_population").collect()}
    assert {"SALE", "Start_Onboarding "} <= spelled
    assert read("models", "fct_user_journey").count() == 200
