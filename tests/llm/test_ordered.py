from __future__ import annotations

import random
from itertools import groupby

from pyspark.sql import functions as F

from strata.llm.ordered import running


def test_totals_of_a_group_over_many_partitions_and_batches(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", None, "", f"g{rng.randrange(40)}"]), k, rng.randrange(-(2**62), 2**62)) for k in range(3000)]
    rng.shuffle(rows)
    want = {}
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    for _, group in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        total = mixed = 0
        for pos, (_, k, v) in enumerate(group):
            total, mixed = total + k, mixed ^ v
            want[k] = (pos, total, mixed)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame(rows, "g string, k long, v long").withColumn("s", F.col("k"))
        out = running(df, ["g"], [F.col("k")], sums=["s"], xors=["v"], parts=11)
        got = out.collect()
        assert out.filter("g = 'hot'").select("part").distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["k"]: (r["pos"], r["s"], r["v"]) for r in got} == want


def test_no_group_and_no_rows(spark):
    df = spark.range(100).withColumn("x", -F.col("id"))
    assert all(r["pos"] == 99 - r["id"] for r in running(df, [], [F.col("x")], parts=7).collect())
    assert running(df.filter("false"), ["id"], [F.col("x")]).collect() == []
