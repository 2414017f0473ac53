"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, settle

#: Up to so many links (4 MB), counted first, one task unites them; more go through the stars.
FEW = 1 << 18


class Forest:
    """Union-find over the nodes of one comparison, fed with arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
        """Unite i with j; the links that were needed for it."""
        used, root = [], self.root
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                return used
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            _, at = np.unique(high, return_index=True)  # one link for each upper root
            used.extend(zip(i[at].tolist(), j[at].tolist(), strict=True))
            root[high[at]] = low[at]
            while not np.array_equal(root, root[root]):
                root[:] = root[root]


def _united(edges: DataFrame) -> DataFrame:
    """(node, component) of links that one task can hold."""

    def run(batches):
        ends = [np.empty((2, 0), np.int64)]
        for batch in batches:
            ends.append(np.stack([batch.column(c).to_numpy() for c in ("u", "v")]))
        nodes, at = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
        at = at.reshape(2, -1)
        forest = Forest(len(nodes))
        forest.add(at[0], at[1])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[forest.root])], names=["node", "component"])
        release()

    return edges.coalesce(1).mapInArrow(run, "node long, component long")


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) for every node of edges (u long, v long): the smallest node it reaches.

    Loops and repeated links are allowed; links with a null end are ignored; no links, no rows. Each
    round of stars halves long chains at least; the links stay on the executors, the driver sees two
    sums. `few` links or fewer need no rounds.
    """
    edges = settle(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state or not now["n"]:
            break
        if now["n"] <= few:
            return _united(edges)
        state = now
        both = edges.union(edges.select("v", "u"))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_least(large), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = settle(small)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
