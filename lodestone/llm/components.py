"""Connected components of an edge list, by alternating large-star and small-star steps (Kiveris et al., 2014).

Before each round every task joins what its own edges connect, up to CHUNK of them at a time, and passes on a star for
each such part: that needs no shuffle, and long chains don't take a round for each halving."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import lookup, saved


#: Edges that a task holds at once.
CHUNK = 1_000_000


def _least(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of n nodes is connected with by the edges (a, b)."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        if (x == y).all():
            return root
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _joined(edges: DataFrame) -> DataFrame:
    """Edges with the same components, each from a node to the least that its chunk of edges connects it with."""

    def stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        a, b = (table.column(k).combine_chunks() for k in range(2))
        nodes = pc.unique(pa.chunked_array([a, b]))
        nodes = nodes.take(pc.sort_indices(nodes))
        a, b = (pc.index_in(x, value_set=nodes).to_numpy(zero_copy_only=False) for x in (a, b))
        root = _least(a, b, len(nodes))
        far = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(far)), nodes.take(pa.array(root[far]))], ["a", "b"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield stars(held)
                held, n = [], 0
        if n:
            yield stars(held)

    return edges.select("a", "b").mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in edges.select("a", "b").schema))


def _star(edges: DataFrame, both: bool, name: str) -> DataFrame:
    """Connect the neighbours of each node that are larger than it (both ways round) or the smaller ones, to the least
    of the neighbourhood. A node's least neighbour is combined before the shuffle, and the neighbours of a hub don't
    meet in one task: `lookup` deals them apart."""
    if both:
        near = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("fill")).select("a", F.least("a", "m").alias("m"), "fill")
    least = saved(least, name)
    joined = lookup(near, least, "a", "fill")
    if both:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for the nodes of edges (a, b); a component is named by its least node. The end is reached when
    both star steps give the edges that they got: compared row by row, as sums of hashes may agree by chance."""
    now = saved(edges.select("a", "b").filter("a <> b").distinct(), name)
    while True:
        now = saved(_joined(now), name)
        large = saved(_star(now, True, name), name)
        new = saved(_star(large, False, name), name)
        if new.count() == now.count() and not new.join(now, ["a", "b"], "left_anti").limit(1).count():
            break
        now = new
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
