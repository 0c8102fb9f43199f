"""Physical-plan properties that matter at scale, checked on sf0.001."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def scale_like(spark):
    """Plan as on a large input: no broadcast of big sides, no runtime re-plan."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _exchanges_above_scan(plan: str, table: str) -> int:
    """Number of Exchange nodes on the path from the root to the scan of ``table``."""
    lines = plan.splitlines()
    idx = [i for i, l in enumerate(lines) if "FileScan" in l and f"/{table}.parquet" in l]
    count = 0
    for i in idx:
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        n = 0
        for j in range(i - 1, -1, -1):
            d = len(lines[j]) - len(lines[j].lstrip(" :+-"))
            if d < depth:
                depth = d
                if "Exchange" in lines[j] and "BroadcastExchange" not in lines[j]:
                    n += 1
        count = max(count, n)
    return count


def test_flagship_shuffles_lab_rows_once(scale_like):
    plan = _plan(E.queries()["flagship"](scale_like, SF0001))
    assert "SortMergeJoin" in plan
    assert _exchanges_above_scan(plan, "lineitem") == 1


def test_scans_read_only_needed_columns(spark):
    plan = _plan(E.queries()["A03"](spark, SF0001))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(set(s.split(",")) <= {"l_orderkey:bigint", "l_quantity:double", "l_extendedprice:double",
                                                 "l_discount:double"} for s in (x.replace(" ", "") for x in schemas))


@pytest.mark.parametrize("qid", ["flagship", "I01", "T01", "J05", "F04", "temporal_all", "E03", "O07", "A15"])
def test_no_row_at_a_time_python(spark, qid):
    plan = _plan(E.queries()[qid](spark, SF0001))
    assert "BatchEvalPython" not in plan and "PythonUDF" not in plan


def test_holiday_flag_is_codegen_projection(spark):
    plan = _plan(E.queries()["F04"](spark, SF0001))
    assert "WholeStageCodegen" in plan or re.search(r"\*\(\d+\) Project", plan)
    assert "Join" not in plan
