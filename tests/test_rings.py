"""Growing components against those of all edges at once."""

import random

from tidemark.operators.scenarios import ring_components
from tidemark.session import work_path
from tidemark.streaming import rings


def found(df):
    return {r.node: r.component for r in df.collect()}


def test_loads_give_the_components_of_all_edges(spark):
    rng = random.Random(6)
    loads = [
        [(f"n{rng.randrange(300):03}", f"n{rng.randrange(300):03}") for _ in range(60)],
        [("hub", f"n{i:03}") for i in range(0, 300, 7)] + [("x", "x"), (None, "n001"), ("hub", "n000")],
        [],
        [("a0", "n005"), ("zz", "zy"), ("zz", "a0"), ("a", "zy")] + [(f"n{rng.randrange(300):03}", f"n{rng.randrange(300):03}") for _ in range(60)],
    ]
    path, seen = work_path(spark, "rings"), []
    for n, rows in enumerate(loads):
        frame = spark.createDataFrame(rows, "src string, dst string")
        rings.add_edges(frame, n, path)
        if n == 1:
            rings.add_edges(frame, n, path)  # a repeated batch
        seen += rows
        whole = ring_components(spark.createDataFrame(seen, "src string, dst string").where("src is not null and dst is not null"))
        assert found(rings.components(spark, path)) == found(whole)
    relabelled = spark.read.schema(rings.RELABELLED).parquet(f"{path}/relabelled").where(f"batch = {len(loads) - 1}")
    old, new = ({r[0] for r in relabelled.select(c).collect()} for c in ("old", "label"))
    assert not old & new  # paths are one step long
