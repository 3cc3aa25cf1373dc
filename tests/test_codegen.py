"""The parsers' generated code compiles; Spark would fall back to slower evaluation without failing."""

import pytest

from clickmetrics.sources import testtables
from clickmetrics.sources.actions import action_lines, parse_actions
from clickmetrics.sources.ads import parse_ads

SF_DIR = "/root/testdata/sf0.001"

PLANS = {
    "actions": lambda spark, mode: parse_actions(action_lines(testtables.user_visit_action(spark, SF_DIR)), mode),
    "ads": lambda spark, mode: parse_ads(testtables.ads_log(spark, SF_DIR), mode),
}


@pytest.mark.parametrize("mode", ["strict", "permissive"])
@pytest.mark.parametrize("name", PLANS)
def test_parsers_compile(spark, name, mode):
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        parsed = PLANS[name](spark, mode)
        assert parsed.count() > 0  # with no column left to read, lines are still checked
        rows = parsed.collect()
        assert len(rows) == parsed.count()
    finally:
        spark.conf.unset("spark.sql.codegen.factoryMode")
        spark.conf.unset("spark.sql.codegen.fallback")
