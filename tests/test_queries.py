"""Every registered query against its SQL answer on the smallest data."""

import os

import pytest

from checks.compare import compare
from checks.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        assert compare(spark, SF, QUERIES[name], ORACLES[name]) == []
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_every_answer_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_all_labels_of_the_review_occur(spark):
    rows = QUERIES["verification_tiers"](spark, SF).collect()
    assert {r.winning_tier for r in rows} == {"tier_1_cache", "tier_2_scraper", "tier_3_llm", "api_check_failed", "failed"}
    values = {r.extracted_value for r in rows}
    assert {"MISSING_YEAR", "TIER_3_FAILED", "API_ERROR", "NO_FILING_EXISTS"} <= values
    assert {"UNKNOWN_CIK"} <= {r.cik for r in rows} and {"UNKNOWN"} <= {r.document_fiscal_year for r in rows}
