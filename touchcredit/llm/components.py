"""Connected components of a link table by alternating star contraction.

Edges are first contracted inside each partition (numpy, no shuffle), which
leaves at most one edge per node and partition. Then large-star and small-star
rounds (Kiveris et al., 2014) run as joins and min-aggregations until nothing
changes: every node then points to the smallest node of its component. Minima
are aggregated before the shuffle, so a hub node is never gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchcredit.llm.common import Workspace


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under the links a[i]-b[i]."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:                            # pointer jumping
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def contract(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with the same components, at most one per node and partition: (node, smaller root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            a = np.concatenate([a, batch.column(0).to_numpy()])
            b = np.concatenate([b, batch.column(1).to_numpy()])
            if len(a) > 200_000:
                a, b = forest(a, b)
                if len(a) > 400_000:           # bounded memory: pass on what cannot be contracted further
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                    a, b = a[:0], b[:0]
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    label = local_components(len(nodes), at[:len(a)], at[len(a):])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def connected_components(edges: DataFrame, ws: Workspace, name: str = "cc") -> DataFrame:
    """(node, root) of every node that has a link to another one; root is the smallest node.

    ``edges``: two long columns, in either direction, repeats and self-links allowed.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns[:2])
    links = edges.select(a.cast("long").alias("a"), b.cast("long").alias("b")).filter("a <> b")
    stars = ws.keep(contract(links).distinct(), f"{name}-0")
    digest = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    state, step = digest(stars), 0
    while True:
        # large star: a node's larger neighbours point to its smallest one
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: a node and its smaller neighbours point to the smallest of them
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(least, F.col("a") == F.col("u")).filter("b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        step += 1
        stars = ws.keep(small, f"{name}-{step}")
        now = digest(stars)
        if now == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now
