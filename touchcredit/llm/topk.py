"""Exact top-k inner-product search: ball-tree branch and bound per shard.

Vectors are dealt into shards of bounded size, and each shard becomes one row
holding a ball tree (centre and radius of every node, rows in leaf order). A
block of queries walks the tree together: a node's inner product is at most
q.c + |q| r, children are taken in the order of that bound, and a query leaves
a node as soon as the bound falls below its current kth score. The kth scores
are shared along the way: shards of a task are searched one after another with
one running result, and the results over a first group of shards are the
starting cut-off of the tasks over all other groups.

Components are floor(scale * x), integers of any size that a double holds. Where
dim x largest x largest component stay below 2^53, sums of doubles are exact.
Where they do not, sums of doubles with a proven error bound choose which rows a
query can still want, and those are scored in whole numbers of any length
(``ExactBest``). Scores are ranked exactly up to 38 digits; the column ``score``
is a long and holds its largest or smallest value where a score passes that.

Rows are dealt into shards by a hash of id and vector, so a repeated id spreads;
of equal rows, k copies take part, as no more can be among a query's best.

Defined cases: null or empty vectors, vectors with null or non-finite
components, and rows without an id take no part. A query never meets rows of
its own id. Ties go to the smaller id. Vectors of another length than the query
are no candidates. Fewer candidates than k give fewer rows. A repeated query
row is answered once; the vectors of a repeated query id are ranked together. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchcredit.llm.common import Workspace

SHARD_ROWS = 4096
LEAF_ROWS = 128
QUERY_ROWS = 1024
#: Shards that one task searches in turn.
GROUP_SHARDS = 16
#: Sums of integers below this are exact in a double.
EXACT = float(1 << 53)


def finite(column: str, scale: float = 1.0) -> Column:
    """Whether a vector has components, all of them finite, also times ``scale``."""
    c = F.col(column)
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & F.forall(
        c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * F.lit(scale)) != float("inf"))), F.lit(False))


def integers(column: pa.Array, dim: int, scale: float) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return np.floor(scale * x)


def reach(x: np.ndarray) -> float:
    """Largest absolute component."""
    return float(np.abs(x).max()) if x.size else 0.0


def integer_rows(x: np.ndarray) -> list[list[int]]:
    return [[int(c) for c in row] for row in x.tolist()]


class BallTree:
    """Rows in leaf order and nodes (first row, end row, left child, right child, centre, radius)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.arange(len(x))
        spans, kids, centres, radii = [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            at, end, parent, side = todo.pop()
            rows = x[order[at:end]]
            centre = rows.mean(axis=0)
            node = len(spans)
            spans.append((at, end))
            kids.append([-1, -1])
            centres.append(centre)
            radii.append(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
            if parent >= 0:
                kids[parent][side] = node
            if end - at > leaf_rows:
                # split across the line between two far rows, at the median
                far = rows[((rows - rows[0]) ** 2).sum(axis=1).argmax()]
                other = rows[((rows - far) ** 2).sum(axis=1).argmax()]
                mid = (end - at) // 2
                order[at:end] = order[at:end][np.argpartition(rows @ (other - far), mid)]
                todo += [(at, at + mid, node, 0), (at + mid, end, node, 1)]
        self.ids, self.x = ids[order], x[order]
        self.spans, self.kids = np.array(spans), np.array(kids)
        self.centres, self.radii = np.array(centres), np.array(radii)


class Best:
    """The k best (score, id) of each query of a block; ``cut`` is its kth score or a proven lower bound of it."""

    def __init__(self, n: int, k: int, cut: np.ndarray):
        self.k, self.cut = k, cut.copy()
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        score = np.hstack([self.score[rows], scores])
        who = np.hstack([self.id[rows], np.broadcast_to(ids, scores.shape)])
        order = np.lexsort((who, -score), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.id[rows] = np.take_along_axis(who, order, axis=1)
        self.cut[rows] = np.maximum(self.cut[rows], self.score[rows, -1])


    def found(self) -> tuple[np.ndarray, np.ndarray, list]:
        """(query rows, ids, scores)."""
        got = np.isfinite(self.score)
        return np.nonzero(got)[0], self.id[got], self.score[got].astype(np.int64).tolist()


class ExactBest:
    """``Best`` in whole numbers of any length, for blocks whose products a double cannot hold."""

    def __init__(self, q: np.ndarray, k: int, cut: np.ndarray):
        self.k, self.cut, self.q = k, cut.copy(), integer_rows(q)
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.q]         # (-score, id), rising

    def offer(self, row: int, x: list[list[int]], ids: list[int]) -> None:
        mine = self.q[row]
        self.best[row] = sorted(self.best[row] + [(-sum(map(int.__mul__, mine, y)), i) for y, i in zip(x, ids)])[:self.k]
        if len(self.best[row]) == self.k:
            # the next double below, so that an exact tie is never cut off
            kth = min(-self.best[row][-1][0], 10 ** 308)
            self.cut[row] = max(self.cut[row], np.nextafter(float(kth), -np.inf) if kth > -10 ** 308 else -np.inf)

    def found(self) -> tuple[np.ndarray, np.ndarray, list]:
        rows = [(r, i, -s) for r, b in enumerate(self.best) for s, i in b]
        return np.array([r for r, _, _ in rows], np.int64), np.array([i for _, i, _ in rows], np.int64), [s for _, _, s in rows]


def search(tree: BallTree, q: np.ndarray, q_ids: np.ndarray, best: Best | ExactBest) -> int:
    """Offer the tree's rows to all queries that they can still help; returns the products computed."""
    norm = np.sqrt((q * q).sum(axis=1))
    # the bound is a float sum: room for its rounding, so that an exact tie is never cut off
    room = 1e-9 * (1.0 + norm * (np.abs(tree.centres).max() * np.sqrt(q.shape[1]) + tree.radii.max()))
    def bound(node: int, rows: np.ndarray) -> np.ndarray:
        b = q[rows] @ tree.centres[node] + norm[rows] * tree.radii[node] + room[rows]
        return np.where(np.isnan(b), np.inf, b)        # components beyond the square root of a double's range
    done = 0
    stack = [(0, np.arange(len(q)))]
    while stack:
        node, rows = stack.pop()
        rows = rows[bound(node, rows) >= best.cut[rows]]
        if not len(rows):
            continue
        left, right = tree.kids[node]
        if left >= 0:
            lo, hi = bound(left, rows).sum(), bound(right, rows).sum()
            stack += [(right, rows), (left, rows)] if lo >= hi else [(left, rows), (right, rows)]
            continue
        at, end = tree.spans[node]
        scores = q[rows] @ tree.x[at:end].T
        done += scores.size
        if isinstance(best, ExactBest):
            # a sum of d products is off by less than (d + 1) rounding errors of the sum of their sizes
            error = (q.shape[1] + 1) * 2.3e-16 * (np.abs(q[rows]) @ np.abs(tree.x[at:end]).T)
            near = ~(scores + error < best.cut[rows][:, None]) & (q_ids[rows][:, None] != tree.ids[None, at:end])
            x = integer_rows(tree.x[at:end]) if near.any() else []
            for i in np.flatnonzero(near.any(axis=1)):
                some = np.flatnonzero(near[i])
                best.offer(int(rows[i]), [x[j] for j in some], tree.ids[at:end][some].tolist())
            continue
        scores[q_ids[rows][:, None] == tree.ids[None, at:end]] = -np.inf
        useful = (scores >= best.cut[rows][:, None]).any(axis=1)
        if useful.any():
            best.offer(rows[useful], scores[useful], tree.ids[at:end])
    return done


def exact_top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
                group_shards: int = GROUP_SHARDS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each row for which ``queries`` (over ``vec_id``) holds."""
    spark = vectors.sparkSession
    ws = Workspace(spark, "top-k")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite("embedding", scale)).withColumn("dim", F.size("embedding"))
    # copies of a row meet as counts; an array of floats is grouped by its bits
    rows = rows.groupBy("vec_id", "embedding", "dim").agg(F.count(F.lit(1)).alias("copies"))
    rows = ws.keep(rows.select("vec_id", "embedding", "dim", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))).alias("copy")), "rows")
    n = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}     # one row per vector length
    asked = rows.filter(F.coalesce(queries, F.lit(False)) & (F.col("copy") == 1))
    n_q = {r["dim"]: r["count"] for r in asked.groupBy("dim").count().collect()}

    def parts(counts: dict[int, int], size: int) -> Column:
        out = F.lit(1)
        for d, c in counts.items():
            out = F.when(F.col("dim") == d, F.lit(max(1, -(-c // size)))).otherwise(out)
        return out

    def plant(table: pa.Table) -> pa.Table:
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        x = integers(table["embedding"].combine_chunks(), dim, scale)
        tree = BallTree(table["vec_id"].to_numpy(), x.astype(np.float64))
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
                         "tree": pa.array([pickle.dumps(tree)], pa.binary()), "reach": pa.array([reach(tree.x)])})

    def pack(table: pa.Table) -> pa.Table:
        dim, block = table["dim"][0].as_py(), table["block"][0].as_py()
        q = integers(table["embedding"].combine_chunks(), dim, scale)
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([block], pa.int32()),
                         "asked": pa.array([pickle.dumps((table["vec_id"].to_numpy(), q, np.full(len(q), -np.inf)))], pa.binary())})

    shards = ws.keep(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding", "copy"), parts(n, shard_rows)).cast("int"))
                     .groupBy("dim", "shard").applyInArrow(plant, "dim int, shard int, tree binary, reach double")
                     .withColumn("group", F.floor(F.col("shard") / group_shards).cast("int")), "shards")
    blocks = ws.keep(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding", F.lit("q")), parts(n_q, query_rows)).cast("int"))
                     .groupBy("dim", "block").applyInArrow(pack, "dim int, block int, asked binary"), "blocks")

    wide = pa.decimal128(38, 0)

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        """Answers of one block of queries over the shards of one group."""
        none = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], wide),
                "dim": pa.array([], pa.int32()), "block": pa.array([], pa.int32())}
        if not left.num_rows or not right.num_rows:
            return pa.table(none)
        dim, block = left["dim"][0].as_py(), left["block"][0].as_py()
        ids, q, cut = pickle.loads(left["asked"][0].as_py())
        small = dim * pc.max(right["reach"]).as_py() * reach(q) < EXACT
        best = Best(len(ids), k, cut) if small else ExactBest(q, k, cut)
        for tree in right["tree"]:
            search(pickle.loads(tree.as_py()), q, ids, best)
        at, who, scores = best.found()
        most = 10 ** 38 - 1
        return pa.table({"query_id": pa.array(ids[at]), "vec_id": pa.array(who),
                         "score": pa.array([max(-most, min(most, x)) for x in scores], wide),
                         "dim": pa.array(np.full(len(at), dim, np.int32)), "block": pa.array(np.full(len(at), block, np.int32))})

    found_type = "query_id long, vec_id long, score decimal(38,0), dim int, block int"

    def run(asked_blocks: DataFrame, of: DataFrame) -> DataFrame:
        # one task per block of queries and group of shards: both sides are small packed rows
        groups = of.select(F.col("dim").alias("of_dim"), F.col("group").alias("of_group")).distinct()
        left = asked_blocks.join(groups, F.col("dim") == F.col("of_dim")).select("dim", "block", F.col("of_group").alias("group"), "asked")
        some = asked_blocks.select(F.col("dim").alias("of_dim"), F.col("block").alias("of_block")).distinct()
        right = of.join(some, F.col("dim") == F.col("of_dim")).select(
            F.col("of_dim").alias("to_dim"), F.col("of_block").alias("to_block"), F.col("group").alias("to_group"), "tree", "reach")
        return (left.groupBy("dim", "block", "group").cogroup(right.groupBy("to_dim", "to_block", "to_group"))
                .applyInArrow(find, found_type))

    found = ws.keep(run(blocks, shards.filter("group = 0")), "first")

    def tighten(left: pa.Table, right: pa.Table) -> pa.Table:
        """The blocks again, with the kth score over the first group as each query's cut-off."""
        if not left.num_rows:
            return left.select(["dim", "block", "asked"])
        ids, q, cut = pickle.loads(left["asked"][0].as_py())
        who, score = right["query_id"].to_numpy(), right["score"].cast(pa.float64()).to_numpy()
        order = np.lexsort((-score, who))
        who, score = who[order], score[order]
        uniq, at, count = np.unique(who, return_index=True, return_counts=True)
        full = count >= k
        kth = dict(zip(uniq[full].tolist(), score[at[full] + k - 1].tolist()))
        cut = np.nextafter(np.array([kth.get(i, -np.inf) for i in ids.tolist()]), -np.inf)    # a proven lower bound, rounded or not
        return pa.table({"dim": left["dim"], "block": left["block"], "asked": pa.array([pickle.dumps((ids, q, cut))], pa.binary())})

    if max(n.values(), default=0) > group_shards * shard_rows or shards.filter("group > 0").limit(1).count():
        seen = found.select("query_id", "score", F.col("dim").alias("to_dim"), F.col("block").alias("to_block"))
        tight = blocks.groupBy("dim", "block").cogroup(seen.groupBy("to_dim", "to_block")).applyInArrow(
            tighten, "dim int, block int, asked binary")
        found = found.unionByName(run(ws.keep(tight, "tight"), shards.filter("group > 0")))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.greatest(F.least(
                "score", F.lit((1 << 63) - 1).cast("decimal(38,0)")), F.lit(-(1 << 63)).cast("decimal(38,0)")).cast("long").alias("score")))
