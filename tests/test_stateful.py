"""Quotas and rate limits of keys whose rows come in many batches."""

import random

import pytest

from quillon.operators import stateful


def test_a_large_key_is_worked_off_in_batches(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, None]), rng.uniform(0, 4000), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, t double, i long")
    accepted, starts = {}, {}
    for key in (1, 2, None):
        kept, begun = [], []
        for _, t, i in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]):
            accepted[i] = sum(x > t - 60 for x in kept) < 4
            kept += [t] * accepted[i]
            begun.append(max([t, *begun[-1:], *([begun[-4] + 60] if len(begun) > 3 else [])]))
            starts[i] = begun[-1]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        quota, limit = stateful.quota(df, "k", "t", "i", 4, 60.0), stateful.rate_limit(df, "k", "t", "i", 4, 60.0)
        assert {r.i: r.accepted for r in quota.collect()} == accepted
        assert {r.i: r.starts_at for r in limit.collect()} == pytest.approx(starts)
        for out in (quota, limit):  # no task takes a whole key as one group
            assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
