import random

from docketry.operators.durable import numbered


def test_numbers_follow_the_order_within_each_key(spark):
    pick = random.Random(4)
    rows = [(pick.choice(["hot"] * 5 + ["a", "b", None]), k, f"x{k}") for k in pick.sample(range(1000), 300)]
    out = numbered(spark.createDataFrame(rows, "k string, o int, v string").repartition(3), "k", ["o"], "n").collect()
    seen = {}
    for k, o, v in sorted(rows, key=lambda r: r[1]):
        seen[v] = sum(1 for other, p, _ in rows if other == k and p <= o)
    assert {r.v: r.n for r in out} == seen
    assert numbered(spark.createDataFrame([], "k string, o int"), "k", ["o"], "n").count() == 0
