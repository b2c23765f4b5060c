"""Connected components of a distributed list of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidymart.session import written

#: Links of which one task makes a forest before tasks exchange any.
LINKS_IN_TASK = 500_000


def _forest_batches(batches):
    """The links of a task as stars: every node with the least one of its component in this task."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = np.fromiter(parent, np.int64, len(parent))
    roots = np.fromiter(map(find, parent), np.int64, len(parent))
    keep = nodes != roots
    yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], ["a", "b"])


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or not larger) neighbours of each node, with the node, on the least of all its neighbours."""
    both = links.union(links.select("b", "a")) if large else links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("least"))
    joined = both.join(least, "a")
    if large:
        return joined.filter("b > a and b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    moved = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def _settled(links: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on anything."""
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("on")).union(links.select("b", F.lit(None)))
    seen = ends.groupBy("node").agg(F.min("on").alias("least"), F.max("on").alias("most"), F.count("on").alias("up"), F.count("*").alias("n"))
    return seen.filter("least <> most or (up > 0 and up < n)").isEmpty()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of every node that has a link; a component is named after its least node.

    Tasks turn a bounded number of links each into stars; then large and small stars alternate until all
    stars agree, which takes about the logarithm of the longest chain of tasks; every round is written, so no lineage
    grows. A node with very many links is spread by the join, which adaptive execution can split. Links to itself,
    repeated links and nulls are ignored.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    named = links.select(a.alias("a"), b.alias("b")).filter("a <> b")
    now = written(named, "component-links")
    while True:
        tasks = max(1, -(-now.count() // LINKS_IN_TASK))
        now = written(now.coalesce(tasks).mapInArrow(_forest_batches, "a long, b long"), "component-forest")
        if tasks == 1 or _settled(now):
            break
        large = written(_stars(now, True), "component-large")
        now = written(_stars(large, False).distinct(), "component-small")
    # A node that is in the links of several tasks hangs on the same root once for each.
    now = now if tasks == 1 else now.distinct()
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return written(now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots), "components")
