"""Connected components of a link table: forests inside tasks, then alternating large-star and small-star.

A task first replaces its links by a spanning forest (every node points to the
smallest node it can reach in the task), so repeated links and dense groups shrink
before anything is shuffled.  Tables are laid out by their counted rows, at most
``PER_TASK`` links a task.  A table that fits in one such task is solved by that
task's forest; a larger one goes through star rounds, which map links to links
on Spark.  Only counts come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickseg.llm.common import cut, packed

PER_TASK = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(u, v)`` links of a task -> one link from each node to the smallest node of its group."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = find(u), find(v)
            if a != c:
                root[max(a, c)] = min(a, c)
    ends = [(u, find(u)) for u in list(root)]
    yield pa.RecordBatch.from_arrays([pa.array([u for u, v in ends if u != v], pa.int64()),
                                      pa.array([v for u, v in ends if u != v], pa.int64())], ["u", "v"])


def _star(edges: DataFrame, small: bool, rows: int) -> DataFrame:
    """One star step.  A node's smallest neighbour (or itself) becomes the end of
    its links; ``small`` keeps links to smaller neighbours, else to larger ones."""
    both = (edges.select(F.col("u").alias("n"), F.col("v").alias("o"))
            if small else
            edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.col("v").alias("o")),
                                           F.struct(F.col("v").alias("n"), F.col("u").alias("o")))).alias("e")
                         ).select("e.n", "e.o"))
    low = both.groupBy("n").agg(F.least(F.min("o"), F.col("n")).alias("m"))
    joined = both.join(low, "n")
    if small:
        linked = joined.select(F.col("o").alias("u"), F.col("m").alias("v")).union(
            low.select(F.col("n").alias("u"), F.col("m").alias("v")))
    else:
        linked = joined.filter(F.col("o") > F.col("n")).select(F.col("o").alias("u"), F.col("m").alias("v"))
    return packed(packed(linked.filter("u != v"), 2 * rows, PER_TASK).distinct(), rows, PER_TASK)


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 60) -> DataFrame:
    """``(node, component)``, one row for every node with a link; the component is its smallest node.

    Null ends and self links are ignored; repeated links count once.  Links to
    a hub with very many nodes are star steps' normal form: the joins key on the
    node and Spark splits the hub's side.
    """
    forest = lambda e: e.mapInArrow(_forest, "u long, v long")
    e = cut(forest(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).dropna().filter("u != v")))
    rows, before = e.count(), None
    for _ in range(max_rounds):
        if rows <= PER_TASK:
            e = cut(forest(e.coalesce(1)))
            break
        e = cut(_star(_star(e, False, rows), True, rows))
        rows, *state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if (rows, state) == before:
            break
        before = rows, state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = packed(e.select("v").distinct(), rows, PER_TASK)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("v", F.col("v").alias("c")))
