import random

import pytest
from pyspark.sql import functions as F

from helpers import components
from tollgate.llm.common import Scratch, connected_components


@pytest.mark.parametrize("kind", ["empty", "random", "path", "star", "loops"])
def test_components_match_union_find(spark, kind):
    rng = random.Random(3)
    edges = {"empty": [], "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)], "path": [(i, i + 1) for i in range(80)],
             "star": [(50, i) for i in range(50)] + [(60, 61)], "loops": [(4, 4), (5, 6), (6, 5), (5, 6)]}[kind]
    got = {r.node: r.component for r in connected_components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges if e[0] != e[1] for x in e})
    linked = {(min(e), max(e)) for e in edges}
    want = components(nodes, lambda i, j: (nodes[j], nodes[i]) in linked)
    assert got == want


def test_scratch_tables_are_removed(spark):
    scratch = Scratch(spark)
    df = scratch.keep(spark.range(5).select(F.col("id")))
    path = df._scratch_path
    assert df.count() == 5
    scratch.drop(df, spark.range(1))
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs)
