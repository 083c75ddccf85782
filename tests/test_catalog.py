"""Every catalog query against its SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from docspark.queries.catalog import CATALOG

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, (float, np.floating)) and math.isnan(x)):
        return "null"
    if isinstance(x, (float, np.floating)):
        return repr(round(float(x), 6))
    if isinstance(x, np.bool_):
        return str(bool(x))
    return str(x)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(plain(v) for v in r) for r in frame[names].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", list(CATALOG))
def test_agrees_with_sql(spark, duck, name):
    run, sql = CATALOG[name]
    got, want = rows(run(spark, SF).toPandas()), rows(duck.execute(sql).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert want[1] or name == "threshold_breaches"


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_work_on_a_small_file_is_dealt_to_all_cores(spark):
    for name in ("legacy_map_national_id", "legacy_map_passport", "legacy_map_bank_statement", "legacy_map_visa", "record_round_trip"):
        got = CATALOG[name][0](spark, "/root/testdata/sf0.001")
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1, name


def test_mixed_receipts_are_read_by_compiled_steps(spark):
    for name in ("receipt_fallback_route", "receipt_repair_merge"):
        plan = CATALOG[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan, name


def test_legacy_texts_are_read_in_one_step(spark):
    """Exploded elements copy every text and array from step to step, and a text that is named twice is kept beside its fields."""
    for name in ("legacy_map_national_id", "legacy_map_passport", "legacy_map_bank_statement", "legacy_map_visa"):
        plan = CATALOG[name][0](spark, SF)._jdf.queryExecution()
        assert "Generate" not in plan.executedPlan().toString(), name
        assert "AS text#" not in plan.optimizedPlan().toString(), name


def test_legacy_mappers_are_compiled(spark):
    """Functions over arrays are interpreted, and so is a generated method of over 8,000 bytes."""
    for name in ("legacy_map_passport", "legacy_map_bank_statement", "legacy_map_visa"):
        plan = CATALOG[name][0](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "lambdafunction" not in plan, name
        assert plan.count("Project") > 4, name
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_mixed_receipts_cut_by_kept_patterns(spark):
    """split() compiles its pattern for each text, so it is given one sign; only bodies that hold the sign are cut by pattern."""
    plan = CATALOG["receipt_repair_merge"][0](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(" not in plan and plan.count(", \x01, -1)") >= 3
