"""The trend of hot keys: a task per range, whatever the ranges' bytes."""

from cohortkit.operators import lab


def test_ranges_of_a_hot_key_are_not_merged_into_few_tasks(spark):
    rows = [(1, i, float(i * i % 97)) for i in range(400)] + [(2 + i % 20, i, float(i)) for i in range(100)] + [(None, 1, 1.0)]
    out = lab.trend(spark.createDataFrame(rows, "k long, o long, v double"), "k", ["o"], ["v"], hot_rows=50, num_partitions=8)
    assert "REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()
    want, last = {}, {}
    for k, o, v in sorted((r for r in rows if r[0] is not None)):
        want[k, o] = v - last[k] if k in last else None
        last[k] = v
    want[None, 1] = None
    assert {(r["k"], r["o"]): r["v_trend"] for r in out.collect()} == want
