import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from refloom.llm import components as C
from refloom.llm.components import connected_components
from refloom.llm.simhash import local_roots


def test_random_graphs(spark, monkeypatch):
    for seed in range(4):
        if seed > 1:  # nearly all nodes are hubs
            monkeypatch.setattr(C, "HUB", seed - 1)
            monkeypatch.setattr(C, "HUBS", 10**6)
        r = random.Random(seed)
        edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, 5000 + k) for k in range(1, 50)] + [(7, 7), (None, 3)]
        df = spark.createDataFrame(edges, "a long, b long")
        got = {x.node: x.root for x in connected_components(df).collect()}
        a, b = (np.array([e[k] for e in edges if None not in e]) for k in (0, 1))
        root = local_roots(6000, a, b)
        assert got == {n: int(root[n]) for n in range(6000) if root[n] != n}
    assert connected_components(df.limit(0)).count() == 0


def test_edges_that_change_from_run_to_run(spark):
    """Each evaluation gives another spanning forest of the same components."""

    def chains(batches):
        import os

        for pdf in batches:
            for _, members in pdf.groupby("c"):
                ids = members["id"].sample(frac=1, random_state=int.from_bytes(os.urandom(4), "little")).tolist()
                yield pd.DataFrame({"a": ids[:-1], "b": ids[1:]})

    members = spark.range(2000).select((F.col("id") % 20).alias("c"), "id").coalesce(1)
    got = connected_components(members.mapInPandas(chains, "a long, b long")).collect()
    assert len(got) == 1980 and all(x.root == x.node % 20 for x in got)


def test_edges_of_a_hub_are_spread(spark):
    """Of a million edges at one node, no task that follows a shuffle reads more than a share; the lesser end or the greater."""
    n = 1_000_000
    lesser = spark.range(1, n + 1).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    greater = spark.range(n).select(F.lit(n).cast("long").alias("a"), F.col("id").alias("b"))
    for edges, at in ((lesser, "b"), (greater, "a")):
        met = C._with_least(edges, at, n)
        plan = met._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftAnti" in plan and met.count() == n and met.agg(F.count_distinct("m")).first()[0] == 1
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < n
    assert connected_components(spark.range(1, 30_001).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))).where("root <> 0").count() == 0
