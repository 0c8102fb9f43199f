"""Redaction leaves texts that pass no rule's test in their tasks."""

from cohortkit.llm import secret_scan

SECRET = "token: abcdefghijkl"


def shuffled(plan) -> int:
    """Rows written to shuffles under a plan that has run."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return shuffled(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return shuffled(plan.plan())
    rows = plan.metrics().get("shuffleRecordsWritten")
    below = plan.children()
    return (rows.get().value() if rows.isDefined() else 0) + sum(shuffled(below.apply(i)) for i in range(below.size()))


def test_texts_without_a_hit_are_not_shuffled(spark):
    rows = [(i, f"plain text number {i}") for i in range(200)] + [(200, f"a {SECRET} b"), (200, f"a {SECRET} b"), (None, SECRET), (201, None), (201, None), (202, "token: short")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = secret_scan.redact(docs)
        got = out._jdf.queryExecution()
        got.executedPlan().executeCollect()
        assert 0 < shuffled(got.executedPlan()) < 20
        assert sorted(out.collect(), key=str) == sorted(((i, t and t.replace(SECRET, "[REDACTED]")) for i, t in rows), key=str)
    finally:
        spark.conf.set(key, before)
