"""Rate limits and quotas with timers, against the batch operators."""

import pytest

from quillon.operators import stateful
from quillon.streaming import limits


def batches_of(spark, folder, parts):
    for part in parts:
        spark.createDataFrame(part, "k int, t double, i int").coalesce(1).write.mode("append").parquet(folder)


def run(spark, out, to, cp):
    for k, v in limits.STORE.items():
        spark.conf.set(k, v)
    q = out.writeStream.format("parquet").option("path", to).outputMode("append").option("checkpointLocation", cp).trigger(availableNow=True).start()
    q.awaitTermination()
    return [o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]]


@pytest.mark.parametrize(("kind", "most", "period"), [("quota", 3, 20.0), ("rate_limit", 2, 10.0)])
def test_equal_to_the_batch_operator(spark, tmp_path, kind, most, period):
    src, to, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    parts = [[(i % 3, 1000 + float(i) / 2 + 0.25 * (i % 4), i) for i in range(a, a + 30)] for a in (0, 30, 60)]
    calls = spark.createDataFrame([r for p in parts for r in p], "k int, t double, i int")
    out = getattr(limits, kind)(spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(src), "k", "t", "i", most, period, late="1 second")
    for part in parts:  # stopped and started again for each
        batches_of(spark, src, [part])
        held = run(spark, out, to, cp)
    want = {r.i: r[2] for r in getattr(stateful, kind)(calls, "k", "t", "i", most, period).collect()}
    seen = {r.i: r[2] for r in spark.read.parquet(to).collect()}
    assert all(want[i] == s for i, s in seen.items())
    if kind == "rate_limit":  # what is not due yet is still held
        assert max(seen.values()) <= 1045 < max(want.values())
    batches_of(spark, src, [[(99, 1e6, 999)], [(99, 1e6 + 1, 1000)]])  # time goes on
    rest = run(spark, out, to, cp)
    rows = [r for r in spark.read.parquet(to).collect() if r.k != 99]
    assert {r.i: r[2] for r in rows} == want and len(rows) == len(want)
    assert rest[-1] < held[-1]  # idle keys' state went


def test_a_long_line_takes_one_timer_a_batch(spark, tmp_path):
    src, to, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    (tmp_path / "in").mkdir()
    calls = [(1, 1000.0, i) for i in range(600)]  # 300 starts, 10 seconds apart
    for k, v in limits.STORE.items():
        spark.conf.set(k, v)
    timers = []
    for part in (calls, [(99, 1e6, 999)]):
        batches_of(spark, src, [part])
        out = limits.rate_limit(spark.readStream.schema("k int, t double, i int").parquet(src), "k", "t", "i", 2, 10.0)
        q = out.writeStream.format("parquet").option("path", to).option("checkpointLocation", cp).trigger(availableNow=True).start()
        q.awaitTermination()
        timers += [o["customMetrics"]["numRegisteredTimers"] for p in q.recentProgress for o in p["stateOperators"]]
    want = {r.i: r.starts_at for r in stateful.rate_limit(spark.createDataFrame(calls, "k int, t double, i int"), "k", "t", "i", 2, 10.0).collect()}
    assert {r.i: r.starts_at for r in spark.read.parquet(to).collect() if r.k == 1} == want
    assert max(timers) <= 2
