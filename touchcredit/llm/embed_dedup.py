"""Near-duplicate embeddings: PCA-ordered tiled comparison.

Vectors are scaled to unit length and rotated to their principal axes, largest
variance first. The leading axes cut them into leaves of neighbours (medians of
a bounded sample, which only balance the leaves), leaves into blocks of bounded
size. Unit vectors of cosine c are sqrt(2 - 2c) apart, and no nearer on some
axes than on all: two leaves whose bounding boxes on the leading axes lie
further apart than the threshold allows are never compared or even sent to each
other. Every other pair of blocks is one task. A task multiplies leading
dimensions first; the rest of a product is at most the product of the two suffix
norms, so a pair stops as soon as its cosine cannot reach the threshold.
Survivors are verified in double precision. Links are counted and contracted
inside the task: no pair leaves it.

Equal vectors are one class with a multiplicity, so large groups of exact
copies cost one row. Defined cases: null, zero and empty vectors, and vectors
with null or non-finite components, link with nothing; neither do vectors of
different length. Rows repeated with one id count as separate vectors. A null
id is never a component id unless its component has no other. Empty tables give
empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from touchcredit.llm.common import Workspace
from touchcredit.llm.components import connected_components, local_components

#: Rows per block; a task holds two blocks and one strip of products.
BLOCK_ROWS = 4096
STRIP_ROWS = 256
#: Leading dimensions are added in steps of this many.
STEP_DIMS = 16
#: Room for rounding of the single-precision bounds.
SLACK = 1e-4
#: Leading axes of a leaf's bounding box, leaves at most, and sampled rows that place their borders.
LEADS = 8
LEAVES = 512
SAMPLE_ROWS = 50_000


def usable(column: str) -> Column:
    """True for a non-empty vector of finite components that is not all zeros."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)       # no overflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Axes by vector length, largest variance first, from all rows: one d x d sum per partition,
    added up in two streaming levels."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims, col = batch.column(0).to_numpy(), batch.column(1)
            for d in np.unique(dims):
                u = unit(matrix(col.take(pa.array(np.flatnonzero(dims == d))), int(d)))
                one = np.vstack([u.T @ u, u.sum(axis=0), np.full(d, float(len(u)))])
                sums[int(d)] = sums.get(int(d), 0) + one
        yield from pack(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[d] = sums.get(d, 0) + np.frombuffer(blob).reshape(d + 2, d)
        yield from pack(sums)

    def pack(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["dim", "sums"])

    schema = "dim int, sums binary"
    parts = (vectors.select("dim", "embedding").mapInArrow(moments, schema)
             .repartition(16).mapInArrow(add, schema).coalesce(1).mapInArrow(add, schema))
    axes = {}
    for dim, blob in parts.collect():                  # one row per vector length
        s = np.frombuffer(bytes(blob)).reshape(dim + 2, dim)
        mean = s[dim] / s[dim + 1]
        _, v = np.linalg.eigh(s[:dim] / s[dim + 1, 0] - np.outer(mean, mean))
        axes[dim] = np.ascontiguousarray(v[:, ::-1])
    return axes


class Leaves:
    """Cells of the leading axes: medians of sampled rows along the widest axis, over and over."""

    def __init__(self, x: np.ndarray, most: int):
        self.axis, self.at, self.kids = [], [], []
        self.count = 0
        todo = [(np.arange(len(x)), max(1, most), None)]
        while todo:
            rows, share, parent = todo.pop()
            spread = x[rows].max(axis=0) - x[rows].min(axis=0) if len(rows) else np.zeros(x.shape[1])
            if share < 2 or not spread.max() > 0:
                node = -1 - self.count                 # a leaf
                self.count += 1
            else:
                node = len(self.axis)
                axis = int(spread.argmax())
                cut = float(np.median(x[rows, axis]))
                low = x[rows, axis] <= cut
                if low.all():                          # the median is the largest value
                    cut = float(x[rows, axis][x[rows, axis] < cut].max())
                    low = x[rows, axis] <= cut
                self.axis.append(axis)
                self.at.append(cut)
                self.kids.append([0, 0])
                todo += [(rows[~low], share // 2, (node, 1)), (rows[low], share - share // 2, (node, 0))]
            if parent:
                self.kids[parent[0]][parent[1]] = node
        self.axis, self.at, self.kids = np.array(self.axis, int), np.array(self.at), np.array(self.kids, int).reshape(-1, 2)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(x), dtype=int) if len(self.axis) else np.full(len(x), -1)
        while (inner := np.flatnonzero(node >= 0)).size:
            k = node[inner]
            node[inner] = self.kids[k, (x[inner, self.axis[k]] > self.at[k]).astype(int)]
        return -1 - node


def near_boxes(low: np.ndarray, high: np.ndarray, threshold: float) -> np.ndarray:
    """Index pairs of boxes that may hold unit vectors of that cosine."""
    gap = np.maximum(0.0, np.maximum(low[:, None] - high[None], low[None] - high[:, None]))
    return np.argwhere((gap ** 2).sum(axis=2) <= 2 - 2 * threshold + SLACK)


def close_pairs(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, threshold: float,
                same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine >= threshold. ``rx``, ``ry``: the rotated rows; ``same``: only i < j."""
    dim = x.shape[1]
    cuts = list(range(0, dim, STEP_DIMS)) + [dim]
    square = lambda r: np.cumsum((r.astype(np.float64) ** 2)[:, ::-1], axis=1)[:, ::-1]
    tail_x, tail_y = square(rx), square(ry)
    tails = [(np.sqrt(tail_x[:, c]), np.sqrt(tail_y[:, c])) if c < dim else (np.zeros(len(rx)), np.zeros(len(ry)))
             for c in cuts[1:]]
    first = cuts[1]
    lead_y = np.ascontiguousarray(ry[:, :first].T)
    tx, ty = (t.astype(np.float32) for t in tails[0])
    low = np.float32(threshold - SLACK)
    for at in range(0, len(rx), STRIP_ROWS):
        end = min(at + STRIP_ROWS, len(rx))
        part = rx[at:end, :first] @ lead_y
        i, j = np.nonzero(part + tx[at:end, None] * ty[None, :] >= low)
        acc = part[i, j].astype(np.float64)
        i = i + at
        if same:
            keep = i < j
            i, j, acc = i[keep], j[keep], acc[keep]
        for k in range(1, len(cuts) - 1):
            if not len(i):
                break
            lo, hi = cuts[k], cuts[k + 1]
            for s in range(0, len(i), 1 << 18):        # bounded gathers for dense strips
                acc[s:s + (1 << 18)] += np.einsum("ij,ij->i", rx[i[s:s + (1 << 18)], lo:hi], ry[j[s:s + (1 << 18)], lo:hi])
            keep = acc + tails[k][0][i] * tails[k][1][j] >= threshold - SLACK
            i, j, acc = i[keep], j[keep], acc[keep]
        for s in range(0, len(i), 1 << 18):
            a, b = i[s:s + (1 << 18)], j[s:s + (1 << 18)]
            hit = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
            yield a[hit], b[hit]


def paired_blocks(classes: DataFrame, axes: Broadcast, threshold: float, block_rows: int) -> DataFrame:
    """The rows of ``classes`` once per block that theirs meets: (dim, i, j, second, cls, copies, embedding), where i <= j
    are the two blocks and ``second`` tells which one the row is of."""
    spark = classes.sparkSession

    def leads(column: pa.Array, dim: int) -> np.ndarray:
        return unit(matrix(column, dim)) @ axes.value[dim][:, :LEADS]

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims):
                x = leads(batch.column(1).take(pa.array(np.flatnonzero(dims == d))), int(d))
                yield pa.RecordBatch.from_arrays([pa.array([int(d)], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["dim", "rows"])

    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    share = F.lit(1)
    for d, n in counts.items():
        share = F.when(F.col("dim") == d, F.lit(-(-n // SAMPLE_ROWS))).otherwise(share)
    drawn: dict[int, list[bytes]] = {}
    some = classes.filter(F.pmod(F.xxhash64("cls", F.lit(3)), share) == 0).select("dim", "embedding")
    for d, rows in some.mapInArrow(sampled, "dim int, rows binary").collect():      # about SAMPLE_ROWS x LEADS numbers per length
        drawn.setdefault(d, []).append(bytes(rows))
    trees = {d: Leaves(np.frombuffer(b"".join(rows)).reshape(-1, min(LEADS, d)), min(LEAVES, -(-counts[d] // block_rows)))
             for d, rows in drawn.items()}
    told = spark.sparkContext.broadcast(trees)

    def placed(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for dim, column in columns:
            dims = dim.to_numpy()
            leaf = np.zeros(len(dims), dtype=np.int32)
            lead: list = [None] * len(dims)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = leads(column.take(pa.array(at)), int(d))
                leaf[at] = told.value[int(d)].place(x) if int(d) in told.value else 0
                for i, row in zip(at, x):
                    lead[i] = row
            yield pa.StructArray.from_arrays([pa.array(leaf), pa.array(lead, pa.list_(pa.float64()))], names=["leaf", "lead"])

    where = classes.withColumn("at", arrow_udf(placed, "leaf int, lead array<double>")("dim", "embedding"))
    edges = [g(F.get(F.col("at.lead"), F.lit(k))).alias(f"{n}{k}") for k in range(LEADS) for g, n in ((F.min, "low"), (F.max, "high"))]
    boxes = where.groupBy("dim", "at.leaf").agg(F.count(F.lit(1)).alias("n"), *edges).collect()      # at most LEAVES per length
    pairs = []
    for d in counts:
        mine = [r for r in boxes if r["dim"] == d]
        m = min(LEADS, d)
        low, high = (np.array([[r[f"{n}{k}"] for k in range(m)] for r in mine]) for n in ("low", "high"))
        subs = [-(-r["n"] // block_rows) for r in mine]
        pairs += [(d, mine[a]["leaf"], subs[a], mine[b]["leaf"], subs[b]) for a, b in near_boxes(low, high, threshold).tolist()]
    meets = spark.createDataFrame(pairs, "of_dim int, of_leaf int, subs int, other_leaf int, other_subs int")   # LEAVES^2 rows at most
    block = lambda leaf, sub: F.shiftleft(leaf.cast("long"), 32) + sub
    dealt = (where.select("dim", "cls", "copies", "embedding", "at.leaf")
             .join(F.broadcast(meets), (F.col("dim") == F.col("of_dim")) & (F.col("leaf") == F.col("of_leaf")))
             .withColumn("block", block(F.col("leaf"), F.pmod(F.xxhash64("cls"), F.col("subs"))))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("other_subs") - 1)))
             .withColumn("other", block(F.col("other_leaf"), F.col("other"))))
    return dealt.select("dim", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        (F.col("block") > F.col("other")).alias("second"), "cls", "copies", "embedding")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    ws = Workspace(spark, "embed-dedup")
    rows = ws.keep(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"),
                                  usable(vector_col).alias("usable")), "rows")
    classes = ws.keep(rows.filter("usable").groupBy("embedding")
                      .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
                      .select(F.monotonically_increasing_id().alias("cls"), "embedding", "copies", "least",
                              F.size("embedding").alias("dim")), "classes")
    axes = principal_axes(classes)
    sent = spark.sparkContext.broadcast(axes)          # one d x d matrix per vector length
    tiles = paired_blocks(classes, sent, threshold, block_rows)

    def compare(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        same = table["i"][0].as_py() == table["j"][0].as_py()
        second = table["second"].to_numpy()
        cls, copies = table["cls"].to_numpy(), table["copies"].to_numpy()
        u = unit(matrix(table["embedding"].combine_chunks(), dim))
        r = (u @ sent.value[dim]).astype(np.float32)
        left = np.arange(len(u)) if same else np.flatnonzero(~second)
        right = left if same else np.flatnonzero(second)
        links = np.zeros(len(u), dtype=np.int64)
        label = np.arange(len(u))
        for a, b in close_pairs(u[left], u[right], r[left], r[right], threshold, same):
            a, b = left[a], right[b]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            joined = local_components(len(u), np.concatenate([np.arange(len(u)), a]), np.concatenate([label, b]))
            label = joined
        told = np.flatnonzero((links > 0) | (label != np.arange(len(u))))
        return pa.table({"cls": pa.array(cls[told]), "root": pa.array(cls[label[told]]), "links": pa.array(links[told])})

    found = ws.keep(tiles.groupBy("dim", "i", "j").applyInArrow(compare, "cls long, root long, links long"), "found")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select("cls", "root"), ws)
    named = (classes.select("cls", "embedding", "copies", "least")
             .join(links.withColumnRenamed("cls", "of_links"), F.col("cls") == F.col("of_links"), "left")
             .join(roots, F.col("cls") == F.col("node"), "left")
             .select("cls", "embedding", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("root", "cls").alias("root")))
    named = ws.keep(named, "named")
    component = named.groupBy(F.col("root").alias("of_root")).agg(F.min("least").alias("component_id"))
    per_class = named.join(component, F.col("root") == F.col("of_root")).select(
        F.col("embedding").alias("of_vector"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.join(per_class, F.col("usable") & (F.col("embedding") == F.col("of_vector")), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
