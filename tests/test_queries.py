"""Registered queries against DuckDB on the smallest data (ALL_QUERIES=1 runs every one)."""

import os
import re

import pytest

import checks
from cargotide.plans.catalog import load

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()
SAMPLE = ("P1_business_date", "P3_bucket_by_business_year", "J1_enrich_sku", "A1_daily_panel", "J2_densify_calendar",
          "J2_densify_calendar_by_year", "A4_month_year_pivot", "W1_rolling_means", "W5_carryover_train", "J4_prior_year_density",
          "J5_yoy_volume", "J6_lunar_yoy_volume", "C13_holiday_features", "C18_pre_holiday_surge", "JOB_calendar_features",
          "W8_sliding_windows", "E4_accuracy_by", "E6_segmented_metrics", "E11_brand_accuracy", "F1_sample_weights",
          "F14_postprocess_category", "S10_upsert", "S5_read_csv_with_encoding", "E8_exact_quantiles_of_lines")
CHOSEN = list(QUERIES) if os.environ.get("ALL_QUERIES") else list(SAMPLE)
SURVEY_IDS = ([f"S{n}" for n in range(1, 13)] + [f"P{n}" for n in range(1, 14)] + [f"J{n}" for n in range(1, 15)]
              + [f"A{n}" for n in range(1, 17)] + [f"W{n}" for n in range(1, 18)] + [f"C{n}" for n in range(1, 26)]
              + [f"L{n}" for n in range(1, 7)] + [f"F{n}" for n in range(1, 15)] + [f"E{n}" for n in range(1, 19)])
NO_SQL = {"A13", "W12", "F2", "F4", "F5", "F7", "JOB"}


def test_every_operator_has_a_query():
    have = {re.match(r"[A-Z]+\d*", name).group() for name in QUERIES}
    assert [i for i in SURVEY_IDS if i not in have] == []


def test_only_non_sql_operators_lack_an_oracle():
    lack = {re.match(r"[A-Z]+\d*", n).group() for n in QUERIES if n not in ORACLES}
    assert lack == NO_SQL


@pytest.fixture(scope="module")
def con():
    return checks.connect(SF_DIR)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name not in ORACLES:
        assert df.count() > 0
        return
    message = checks.compare(df, con, ORACLES[name])
    assert message.startswith("ok") and "TYPES" not in message, message


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["ACTUALSHIPDATE", "CATEGORY", "Total QTY", "Total CBM", "rolling_mean_7d"] and df.count() > 10_000
    assert set(entry.oracle_sql()) <= set(entry.queries())
