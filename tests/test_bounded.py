"""Oversampling in bounded pieces, and files that are let go of."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillpoint.functions import lineage
from tillpoint.operators import oversampling as over


def test_boxes_rule_out_blocks_in_spite_of_far_outliers():
    """A ball around a pivot reaches to its farthest row; a box ends where its rows end, so few blocks are asked for a row."""
    pick = np.random.default_rng(3)
    x = pick.lognormal(8, 2, size=(20_000, 3))
    nodes = over._split(x[::60], 20)
    cells = over._cells(nodes, x)
    assert len(np.unique(cells)) == 20
    located = []
    for cell in np.unique(cells):
        mine = np.flatnonzero(cells == cell)
        part = pd.DataFrame({"id": mine, "x": list(x[mine]), "cell": np.int32(cell), "part": np.int32(0)})
        located.append(over._locate(5, 500)(part))
    located = pd.concat(located)
    ends = located[located["low"].notna()]
    boxes = over._Boxes([*zip(ends["cell"], ends["part"], ends["sub"])], np.stack(ends["low"]), np.stack(ends["high"]))
    batches = list(over._route(boxes, np.ones(len(ends), dtype="int64"))(iter([located.assign(lane=0)])))
    assert sum(map(len, batches)) < 4 * len(x) and max(map(len, batches)) <= over.BLOCK + 500
    asked = next(iter(over._counts(boxes)(iter([located]))))
    assert asked["n"].sum() == sum(map(len, batches))


def test_copies_of_a_cell_are_dealt_to_several_blocks():
    same = np.zeros((1000, 2))
    assert over._split(same, 4) == [(-1, 0.0, 0, -1)]
    assert sorted(len(b) for b in over._halves(same, 300)) == [250] * 4


def test_a_long_step_lets_go_of_the_files_before_it(spark, monkeypatch):
    """The frame that was staged does not hold on to the shuffles of its own run."""
    called = []
    monkeypatch.setattr(lineage, "release", called.append)
    df = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
    lineage.stage(df)
    assert called == [] and "isFinalPlan=false" in df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lineage, "LONG_STEP", 0.0)
    assert lineage.stage(df).count() == 3 and called == [spark]
