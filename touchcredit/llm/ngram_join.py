"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

1. Every text becomes its set of distinct 4-word shingles (64-bit hashes). Equal
   sets are one class, so exact copies never meet each other.
2. Shingles are ordered rare first by a count sketch of fixed size: any fixed
   order makes prefix filtering exact, the counts only make it selective. Each
   class posts the first n - ceil(t*n) + 1 shingles of its set: two sets that
   reach the threshold share one of them.
3. Postings meet by shingle, sorted by set size; those that share one are kept.
   By the positional filter the smaller set of a pair holds its first shared
   shingle within its shorter index prefix. Within a group of up to
   ``GROUP_PAIRS`` sets, the pairs that pass the length and positional filters
   are listed. In a larger group a posting is chained to the nearest index
   posting before it that the length filter allows, which is linear in the
   postings. Pairs, once each, meet histograms of their sets, whose size goes
   with the set's: those that pass are candidates. Sets of a larger group that
   the candidates do not connect are listed in a second round, pair by pair up
   to ``MANY_PAIRS`` sets. Above that they are chained as they are: index
   postings of one length range are chained to each other that way, so no pair
   is lost. The connected candidates are the clusters.
4. Texts of a cluster meet in chunks of bounded size, and a task verifies the
   pairs that share a prefix shingle and pass the length, positional and suffix
   filters, once each and only while the two are not connected yet. Large
   clusters take three rounds: inside chunks, each chunk with the first one,
   and last those outside the cluster's main component with everything they
   have not met. So no link between components is lost, and pairs inside one
   are not enumerated.

Sets are compared by hash: two different shingles or sets are taken for equal
with a chance of 2**-64 per pair.

Defined cases: null or empty text has no shingles and links with nothing; texts
under four words are one shingle, the whole sequence; a null id takes its
class's component but is never a component's id; rows repeated with an id are
classed by their own text. Empty tables give empty results; other columns are
not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from touchcredit.llm.common import Workspace, free_name, tidy
from touchcredit.llm.components import connected_components
from touchcredit.llm.textscan import find_words, hash_words, mix64, text_slices

SKETCH_BITS = 20
#: Cells of a packed piece of the sketch.
PIECE = 1 << 12
#: Bits of the bitmap of wanted ids (8 MB), and of its pieces.
ID_BITS, ID_PIECE_BITS = 26, 16
#: Members and shingles of a chunk, on average.
CHUNK_ROWS = 512
CHUNK_SHINGLES = 400_000
HISTOGRAM_BITS = 4
#: Sets that share a shingle, up to which their pairs are listed at once.
GROUP_PAIRS = 8
#: Sets that share a shingle and are not connected by chains, up to which their pairs are listed.
MANY_PAIRS = 4096
#: Cells of a histogram, unless its set asks for another number.
SUMMARY = 128

#: One odd multiplier per word of a shingle. They must not be multiples of one another, or
#: shingles with the same words in another order can meet.
_PLACE = list(mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1))
_SHORT = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a slice."""
    starts, ends, at = find_words(data, offs)
    h = hash_words(data, starts, ends)
    m = max(0, len(h) - words + 1)
    grams = np.zeros(m, dtype=np.uint64)
    for k in range(words):
        grams += h[k:k + m] * _PLACE[k]
    grams = mix64(grams)
    for r in range(len(offs) - 1):
        lo, hi = at[r], at[r + 1]
        n = hi - lo
        if n >= words:
            yield np.unique(grams[lo:hi - words + 1])
        elif n:
            x = _SHORT + np.uint64(n)
            for w in h[lo:hi]:
                x = _chain(x, w)
            yield np.array([x], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _chain(x: np.uint64, w: np.uint64) -> np.uint64:
    return mix64(np.array([(int(x) * int(_PLACE[0]) + int(w)) % (1 << 64)], dtype=np.uint64))[0]


def signature(grams: np.ndarray) -> int:
    """64-bit signature of a set: finalised sum of finalised members, with its size."""
    with np.errstate(over="ignore"):
        s = mix64(grams ^ _SHORT).sum(dtype=np.uint64) + np.uint64(len(grams)) * _PLACE[1]
    return int(mix64(np.array([s], dtype=np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def sketch_cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def summary(grams: np.ndarray, cells: int | None = None) -> bytes:
    """Counts of the set's members by cell; 255 stands for that many or more."""
    cells = cells or SUMMARY
    return np.minimum(np.bincount((grams % np.uint64(cells)).astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes()


def summary_cells(n: int, percent: int) -> int:
    """Cells (a power of two) with which sets of ``n`` that share little hardly pass for near ones.

    Two such sets differ by about 0.56 * sqrt(cells * n), give or take 0.43 * sqrt(n); near ones by a share of n.
    """
    least = ((100 - percent) / (100 + percent) / 0.56 * math.sqrt(n) + 4) ** 2
    return 1 << max(4, math.ceil(math.log2(least)))


def shared_at_most(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bound of the intersection of sets with these summaries (rows); a wider one is folded."""
    cells = min(a.shape[1], b.shape[1])
    least = np.full((len(a), cells), np.iinfo(np.int32).max, dtype=np.int32)
    for x in (a, b):
        x = x.reshape(len(x), x.shape[1] // cells, cells)
        some = (x == 255).any(axis=1)
        least = np.minimum(least, np.where(some, np.iinfo(np.int32).max, x.sum(axis=1, dtype=np.int32)))
    full = (least == np.iinfo(np.int32).max).any(axis=1)
    return np.where(full, np.iinfo(np.int64).max, least.sum(axis=1, dtype=np.int64))


def fingerprints(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, sig, cells: histogram of the set) of every document, and (piece, cells) of each partition's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        names = ["doc_id", "n", "sig", "piece", "cells"]
        for batch in batches:
            sizes, sigs, summaries = [], [], []
            for _, _, data, offs in text_slices(batch.column(1)):
                cells = []
                for grams in shingle_sets(data, offs, words):
                    sizes.append(len(grams))
                    summaries.append(summary(grams, summary_cells(len(grams), percent)))
                    sigs.append(signature(grams) if len(grams) else None)
                    cells.append(sketch_cell(grams))
                sketch += np.bincount(np.concatenate(cells), minlength=len(sketch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(sigs, pa.int64()),
                                              pa.nulls(len(sizes), pa.int32()), pa.array(summaries, pa.binary())], names=names)
        pieces = range(len(sketch) // PIECE)
        packed = [zlib.compress(sketch[k * PIECE:(k + 1) * PIECE].tobytes(), 1) for k in pieces]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(packed), pa.int64()), pa.nulls(len(packed), pa.int64()), pa.nulls(len(packed), pa.int64()),
                                          pa.array(list(pieces), pa.int32()), pa.array(packed, pa.binary())], names=names)

    return docs.mapInArrow(tidy(run), "doc_id long, n long, sig long, piece int, cells binary")


def summed_sketch(pieces: DataFrame) -> np.ndarray:
    """The sketch of all partitions: pieces are added up in a stream, so only sums are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(cells), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                         names=["piece", "cells"])

    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for k, cells in pieces.repartition("piece").mapInArrow(tidy(run), "piece int, cells binary").collect():    # fixed size
        counts[k * PIECE:(k + 1) * PIECE] = np.frombuffer(bytes(cells), dtype=np.int64)
    return counts


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for every id (a long column): 2**ID_BITS bits, by hash."""
    cells = ids.select(id_cell(F.col(ids.columns[0])).alias("cell"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            cell = batch.column(0).to_numpy()
            for k in np.unique(cell >> ID_PIECE_BITS).tolist():
                bits = pieces.setdefault(k, np.zeros(1 << ID_PIECE_BITS, dtype=bool))
                bits[cell[(cell >> ID_PIECE_BITS) == k] & ((1 << ID_PIECE_BITS) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), pa.array([np.packbits(x).tobytes() for x in pieces.values()], pa.binary())],
                                         names=["piece", "bits"])

    out = np.zeros(1 << (ID_BITS - 3), dtype=np.uint8)
    size = 1 << (ID_PIECE_BITS - 3)
    piece = F.shiftright("cell", ID_PIECE_BITS)
    for k, bits in cells.repartition(piece).mapInArrow(tidy(run), "piece int, bits binary").collect():       # 2**(ID_BITS - 3) bytes
        out[k * size:(k + 1) * size] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return out


def id_cell(column: Column) -> Column:
    return F.xxhash64(column).bitwiseAND(F.lit((1 << ID_BITS) - 1))


def may_hold(bits: np.ndarray, column: Column, spark) -> Column:
    """Whether an id's bit is set: true for all ids put in, and few others while the bitmap is not full."""
    sent = spark.sparkContext.broadcast(bits)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for cells in columns:
            cell = cells.to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.array((sent.value[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1)

    return arrow_udf(tidy(run), "boolean")(id_cell(column))


def postings(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """(gram, n, sig, pos) of the prefix of every document's set, ``pos`` its place there; copies within a task post once."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)       # 2**SKETCH_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = sent.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(1)):
                grams_out, n_out, sig_out, pos_out = [], [], [], []
                for grams in shingle_sets(data, offs, words):
                    n = len(grams)
                    if not n:
                        continue
                    sig = signature(grams)
                    if sig in seen:
                        continue
                    if len(seen) > 500_000:                       # repeats only cost room
                        seen.clear()
                    seen.add(sig)
                    p = prefix_length(n, percent)
                    count = rarity[sketch_cell(grams)]
                    grams_out.append(grams[np.argsort(count, kind="stable")[:p]])   # ties by hash: grams are sorted
                    n_out.append(np.full(p, n))
                    sig_out.append(np.full(p, sig))
                    pos_out.append(np.arange(p))
                if grams_out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(grams_out).view(np.int64)), pa.array(np.concatenate(n_out).astype(np.int32)),
                         pa.array(np.concatenate(sig_out)), pa.array(np.concatenate(pos_out).astype(np.int32))], names=["gram", "n", "sig", "pos"])

    return docs.mapInArrow(tidy(run), "gram long, n int, sig long, pos int")


def index_posting(percent: int) -> Column:
    """Whether a posting can be the first that its set shares with a partner of its size or larger: need <= n - pos."""
    return F.col("pos") <= F.col("n") - F.expr(f"cast((2 * {percent} * cast(n as long) + {99 + percent}) div {100 + percent} as int)")


def shared_postings(posted: DataFrame) -> DataFrame:
    """The postings, once each, whose shingle several sets have posted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                            # the last posting so far, and whether it is known to be shared
        for batch in batches:
            names = batch.schema.names
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            gram, sig = cols[0], cols[2]
            new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (sig[1:] != sig[:-1])])
            cols = [c[new] for c in cols]
            gram = cols[0]
            same = gram[1:] == gram[:-1]
            shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            # the last one waits: it may repeat or be shared in the next batch
            if held is not None and carried and len(gram) > 1:
                shared[0] = True
            carried = bool(shared[-1]) or (held is not None and carried and len(gram) == 1)
            out = shared[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(c[:-1][out]) for c in cols], names=names)
            held = [c[-1:] for c in cols]
        if held is not None and carried:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], names=names)

    return posted.repartition("gram").sortWithinPartitions("gram", "n", "sig").mapInArrow(tidy(run), "gram long, n int, sig long, pos int")


def candidates(shared: DataFrame, percent: int) -> DataFrame:
    """Links (a, b): filtered pairs of small groups, chains of large ones.

    ``shared``: postings (gram, n, sig, head), ``head`` for index postings, and what else is to filter pairs:
    ``pos``, the place in the prefix, or ``cells``, the summary.
    """

    def pairs_of(cols: dict[str, np.ndarray], first: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
        n, sig, head = cols["n"], cols["sig"], cols["head"]
        for k in np.unique(size[size > 1]):
            lo, hi = np.triu_indices(int(k), 1)
            at = first[size == k]
            step = max(1, 200_000 // len(lo))
            for s in range(0, len(at), step):
                x, y = (at[s:s + step, None] + lo).ravel(), (at[s:s + step, None] + hi).ravel()
                near = head[x] & (100 * n[x] >= percent * n[y])
                x, y = x[near], y[near]
                need = -(-percent * (n[x] + n[y]) // (100 + percent))
                if "pos" in cols:
                    near = np.minimum(n[x] - cols["pos"][x], n[y] - cols["pos"][y]) >= need
                    x, y, need = x[near], y[near], need[near]
                if "cells" in cols:
                    x, y = (v[shared_at_most(cols["cells"][x], cols["cells"][y]) >= need] for v in (x, y))
                yield np.stack([sig[x], sig[y]], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, first, size, big in groups(batches, GROUP_PAIRS):
            found = [np.zeros((0, 2), np.int64), *pairs_of(cols, first[~big], size[~big])]
            inside = np.repeat(big, size)
            if inside.any():
                found.append(chained({k: c[inside] for k, c in cols.items()}, percent))
            yield linked(np.unique(np.concatenate(found), axis=0))

    return shared.repartition("gram").sortWithinPartitions("gram", "n", "sig").mapInArrow(tidy(run), "a long, b long")


def linked(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])


def chained(cols: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """Links of each posting to the nearest index posting before it in its group."""
    gram, n, sig, head = (cols[k] for k in ("gram", "n", "sig", "head"))
    before = np.concatenate([[-1], np.maximum.accumulate(np.where(head, np.arange(len(head)), -1))[:-1]])
    y = np.flatnonzero(before >= 0)
    x = before[y]
    near = (gram[x] == gram[y]) & (100 * n[x] >= percent * n[y])
    return np.stack([sig[x[near]], sig[y[near]]], axis=1)


def groups(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]]:
    """(columns, first row, rows, large) of the groups of sorted postings: whole ones of up to ``limit`` rows, and
    larger ones as they come, each part behind the last index posting of the part before."""
    held: dict[str, np.ndarray] | None = None  # the last group so far, or of a large one its last index posting (or row)
    large = False
    for batch in chain(batches, [None]):
        if batch is not None:
            cols = {k: c for k, c in zip(batch.schema.names, batch.columns)}
            cols = {k: c.to_numpy(zero_copy_only=False) if k != "cells" else
                    np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint8).reshape(len(c), -1) if len(c) else None for k, c in cols.items()}
            cols["n"] = cols["n"].astype(np.int64)
            if not len(cols["gram"]):
                continue
            if held is not None:
                cols = {k: np.concatenate([held[k], c]) for k, c in cols.items()}
        elif held is None:
            return
        else:
            cols = held
        gram = cols["gram"]
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        size = np.diff(np.append(first, len(gram)))
        big = size > limit
        big[0] |= large
        if batch is not None and not big[-1]:                  # the last group may go on
            done = first[-1]
            held, large = {k: c[done:] for k, c in cols.items()}, False
            first, size, big = first[:-1], size[:-1], big[:-1]
        else:
            done = len(gram)
            heads = np.flatnonzero(cols["head"][first[-1]:])
            last = first[-1] + heads[-1] if len(heads) else len(gram) - 1
            held, large = {k: c[last:last + 1] for k, c in cols.items()} if batch is not None else None, True
        if len(first):
            yield {k: c[:done] for k, c in cols.items()}, first, size, big


def close(links: DataFrame, summaries: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) whose sets may be near by their summaries (sig, n, cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(k).to_numpy().astype(np.int64) for k in range(4))
            cells = [batch.column(k).to_pylist() for k in (4, 5)]
            wide = np.array([[len(x) for x in c] for c in cells], dtype=np.int64).reshape(2, -1)
            need = -(-percent * (n_a + n_b) // (100 + percent))
            keep = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
            for w in np.unique(wide[:, keep], axis=1).T:
                rows = np.flatnonzero(keep & (wide[0] == w[0]) & (wide[1] == w[1]))
                step = max(1, (1 << 20) // int(w.max()))
                for s in range(0, len(rows), step):
                    at = rows[s:s + step]
                    x, y = (np.frombuffer(b"".join(c[i] for i in at), dtype=np.uint8).reshape(len(at), -1) for c in cells)
                    keep[at] = shared_at_most(x, y) >= need[at]
            yield linked(np.stack([a[keep], b[keep]], axis=1))

    side = lambda k: summaries.select(F.col("sig").alias(k), F.col("n").alias(f"n_{k}"), F.col("cells").alias(f"cells_{k}"))
    return (links.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "cells_a", "cells_b")
            .mapInArrow(tidy(run), "a long, b long"))


def across(labelled: DataFrame, percent: int) -> DataFrame:
    """Links (a, b, sure) between sets of a large group that have different labels: pairs that pass the filters, or,
    of groups above ``MANY_PAIRS``, chains (``sure``: they stand for others and are not to be filtered).

    ``labelled``: postings (gram, n, sig, pos, head, label).
    """

    def pairs_of(cols: dict[str, np.ndarray]) -> Iterator[np.ndarray]:
        n, pos, sig, label, head = (cols[k] for k in ("n", "pos", "sig", "label", "head"))
        ends = np.searchsorted(n, 100 * n // percent, side="right")                    # length
        at = 0
        while at < len(n):
            upto = min(len(n), at + max(1, 500_000 // max(1, int(ends[at]) - at)))
            x, y = np.arange(at, upto)[:, None], np.arange(at, int(ends[upto - 1]))[None, :]
            need = -(-percent * (n[x] + n[y]) // (100 + percent))
            ok = (y > x) & head[x] & (label[x] != label[y]) & (100 * n[x] >= percent * n[y])
            ok &= np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need
            i, j = np.nonzero(ok)
            yield np.stack([sig[at + i], sig[at + j]], axis=1)
            at = upto

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, first, size, big in groups(batches, MANY_PAIRS):
            listed, sure = [np.zeros((0, 2), np.int64)], np.zeros((0, 2), np.int64)
            inside = np.repeat(big, size)
            if inside.any():
                of = dict(zip(cols["sig"].tolist(), cols["label"].tolist()))
                sure = np.unique(chained({k: c[inside] for k, c in cols.items()}, percent), axis=0)
                sure = sure[np.array([of[a] != of[b] for a, b in sure.tolist()], dtype=bool)] if len(sure) else sure
            for at, rows in zip(first[~big], size[~big]):
                label = cols["label"][at:at + rows]
                if rows > GROUP_PAIRS and (label != label[0]).any():
                    listed += pairs_of({k: c[at:at + rows] for k, c in cols.items()})
            listed = np.unique(np.concatenate(listed), axis=0)
            both = linked(np.concatenate([listed, sure]))
            yield pa.RecordBatch.from_arrays([*both.columns, pa.array(np.arange(both.num_rows) >= len(listed))], names=["a", "b", "sure"])

    return labelled.repartition("gram").sortWithinPartitions("gram", "n", "sig").mapInArrow(tidy(run), "a long, b long, sure boolean")


class Sets:
    """The sets of a task in local shingle numbers, with prefixes in a rare-first order of the task."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.n = np.array([len(s) for s in sets], dtype=np.int64)
        self.offs = np.concatenate([[0], np.cumsum(self.n)])
        everything = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        values, code, count = np.unique(everything, return_inverse=True, return_counts=True)
        order = np.argsort(count, kind="stable")                  # rare first
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        self.size = len(values)
        code = rank[code]
        self.members = [np.sort(code[a:b]) for a, b in zip(self.offs[:-1], self.offs[1:])]
        self.prefix = [m[:prefix_length(len(m), percent)] if len(m) else m for m in self.members]
        # suffix filter: shared members of a part of the order are at most the smaller count there
        bins = 1 << HISTOGRAM_BITS
        self.histogram = np.zeros((len(sets), bins), dtype=np.int64)
        for i, m in enumerate(self.members):
            self.histogram[i] = np.bincount(m * bins // max(1, self.size), minlength=bins)[:bins]


def linked_labels(sets: list[np.ndarray], label: np.ndarray, allowed, percent: int) -> np.ndarray:
    """Component label of each set after joining all allowed pairs that reach the threshold.

    ``label``: components known so far (small integers); ``allowed(i, others)``: mask of the
    pairs this task is to look at.
    """
    s = Sets(sets, percent)
    parent = label.copy()

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_size = np.argsort(s.n, kind="stable")
    place = np.empty(len(by_size), dtype=np.int64)
    place[by_size] = np.arange(len(by_size))
    # inverted index of the prefixes: shingle -> sets by size, with the position in the prefix
    gram = np.concatenate([*s.prefix, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(sets)), [len(p) for p in s.prefix])
    pos = np.concatenate([*(np.arange(len(p)) for p in s.prefix), np.zeros(0, np.int64)])
    order = np.lexsort((place[owner], gram)) if len(gram) else np.zeros(0, np.int64)
    gram, owner, pos = gram[order], owner[order], pos[order]
    mark = np.zeros(s.size, dtype=bool)
    for y in by_size:
        if not s.n[y]:
            continue
        lo, hi = np.searchsorted(gram, s.prefix[y]), np.searchsorted(gram, s.prefix[y], side="right")
        take = hi - lo
        if take.sum() <= len(take):                               # nothing but itself
            continue
        at = np.repeat(lo, take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)
        x, px, py = owner[at], pos[at], np.repeat(np.arange(len(take)), take)
        keep = place[x] < place[y]
        x, px, py = x[keep], px[keep], py[keep]
        if not len(x):
            continue
        x, first = np.unique(x, return_index=True)                # the first shared prefix shingle of each
        need = -(-percent * (s.n[x] + s.n[y]) // (100 + percent))
        keep = 100 * s.n[x] >= percent * s.n[y]                                                   # length
        keep &= np.minimum(s.n[x] - px[first], s.n[y] - py[first]) >= need                # positional
        keep &= np.minimum(s.histogram[x], s.histogram[y]).sum(axis=1) >= need                    # suffix
        keep &= allowed(y, x)
        x, need = x[keep], need[keep]
        if not len(x):
            continue
        mark[s.members[y]] = True
        for i, least in zip(x.tolist(), need.tolist()):
            a, b = find(parent[i]), find(parent[y])
            if a != b and np.count_nonzero(mark[s.members[i]]) >= least:
                parent[max(a, b)] = min(a, b)
        mark[s.members[y]] = False
    return np.array([find(p) for p in parent.tolist()], dtype=np.int64)


def verify(tasks: DataFrame, labels: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) found by the tasks: rows (cluster, task, part, side, chunk, last, sig, text).

    A pair is looked at if it has a row of each side, or any pair if all rows have side 0;
    between sides, members of one chunk have met before, and in the last round so has the
    first chunk with all others. ``labels``: the components known so far, dealt to the same tasks.
    """

    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        sets: list[np.ndarray] = []
        for _, _, data, offs in text_slices(table["text"]):
            sets.extend(shingle_sets(data, offs, words))
        sig, side = table["sig"].to_numpy(), table["side"].to_numpy()
        # one row per set and side, whose text is the one that was classed (an id may repeat with another text)
        right = np.array([len(s) > 0 and signature(s) == g for s, g in zip(sets, sig)], dtype=bool)
        at = np.flatnonzero(right)
        _, first = np.unique(np.stack([sig[at], side[at]]), axis=1, return_index=True)
        at = at[np.sort(first)]
        sets = [sets[i] for i in at]
        sig, side, chunk, last = sig[at], side[at], table["chunk"].to_numpy()[at], table["last"].to_numpy()[at]
        # rows of one signature or one label are connected already: start from the first row of each
        label = dict(zip(known["sig"].to_pylist(), known["label"].to_pylist()))
        place: dict[int, int] = {}
        start = np.array([place.setdefault(label.get(g, g), i) for i, g in enumerate(sig.tolist())], dtype=np.int64)
        two = side.max(initial=0) > 0

        def allowed(i: int, others: np.ndarray) -> np.ndarray:
            if not two:
                return np.ones(len(others), dtype=bool)
            ok = (side[others] != side[i]) & (chunk[others] != chunk[i])
            return ok & ~(last[others] & ((chunk[others] == 0) | (chunk[i] == 0)))

        found = linked_labels(sets, start, allowed, percent)
        moved = np.flatnonzero(found != np.arange(len(found)))
        return pa.table({"a": pa.array(sig[moved]), "b": pa.array(sig[found[moved]])})

    told = labels.select(F.col("cluster").alias("of_cluster"), F.col("task").alias("of_task"), F.col("part").alias("of_part"), "sig", "label")
    return (tasks.groupBy("cluster", "task", "part").cogroup(told.groupBy("of_cluster", "of_task", "of_part"))
            .applyInArrow(run, "a long, b long"))


def to_first_chunk(rows: DataFrame, *payload: str) -> DataFrame:
    """Tasks of the second round: every further chunk of a cluster with its first one."""
    cols = ["chunk", F.lit(False).alias("last"), "sig", *payload]
    others = rows.filter("chunk > 0").select("cluster", F.col("chunk").alias("task"), F.lit(0).alias("part"), F.lit(0).alias("side"), *cols)
    hub = rows.filter("chunk = 0").withColumn("task", F.explode(F.sequence(F.lit(1), F.col("chunks") - 1)))
    return others.unionByName(hub.select("cluster", "task", F.lit(0).alias("part"), F.lit(1).alias("side"), *cols))


def to_outsiders(rows: DataFrame, outside: DataFrame, *payload: str) -> DataFrame:
    """Tasks of the last round: parts of the outsiders of a cluster with each of its further chunks.

    ``outside``: (out_sig, of_cluster, parts), the members outside their cluster's main component.
    """
    cols = ["chunk", F.lit(True).alias("last"), "sig", *payload]
    parts = outside.select("of_cluster", "parts").distinct()
    others = (rows.filter("chunk > 0").join(parts, F.col("cluster") == F.col("of_cluster"))
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("cluster", F.col("chunk").alias("task"), "part", F.lit(0).alias("side"), *cols))
    part = F.pmod(F.xxhash64("sig", F.lit(1)), F.col("parts")).cast("int")
    asks = (rows.join(outside, F.col("sig") == F.col("out_sig"))
            .withColumn("task", F.explode(F.sequence(F.lit(1), F.col("chunks") - 1)))
            .select("cluster", "task", part.alias("part"), F.lit(1).alias("side"), *cols))
    return others.unionByName(asks)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; links at Jaccard >= ``percent`` / 100."""
    return classed(docs, id_col, text_col, words, percent).drop("sig", "root")


def deduplicate(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others) with the smallest id of their component.

    Rows without shingles stay. Of rows without an id, one stays of a component that
    has no id at all. If kept ids are repeated, the row is picked by its text's
    signature, and one of rows equal in both stays.
    """
    found = Workspace(docs.sparkSession, "ngram-dedup").keep(classed(docs, "doc_id", "text", words, percent), "classed")
    kept = found.filter("doc_id = component_id").select(F.col("doc_id").alias("of_doc"), F.col("sig").alias("of_sig"))
    sig = free_name(docs, "sig")
    unnamed = (found.filter("doc_id is null and component_id is null and sig is not null").groupBy("root")
               .agg(F.min("sig").alias("of_sig")).select("of_sig"))
    anonymous = docs.filter("doc_id is null").withColumn(sig, signatures("text", words))
    anonymous = (anonymous.join(unnamed, F.col(sig) == F.col("of_sig"), "left_semi").dropDuplicates([sig])
                 .unionByName(anonymous.filter(F.col(sig).isNull())).drop(sig))
    if found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        rows = docs.withColumn(sig, signatures("text", words))
        rows = rows.join(kept.distinct(), (F.col("doc_id") == F.col("of_doc")) & F.col(sig).eqNullSafe(F.col("of_sig")), "left_semi")
        # rows without shingles are linked with nothing, not even with each other
        some = rows.filter(F.col(sig).isNotNull()).dropDuplicates(["doc_id", sig]).unionByName(rows.filter(F.col(sig).isNull())).drop(sig)
    else:
        # most documents are kept: their texts stay where they are, by a bitmap of the ids that go
        gone = found.filter("doc_id is not null and doc_id <> component_id").select("doc_id")
        may_go = may_hold(id_bits(gone), F.col("doc_id").cast("long"), docs.sparkSession)
        named = docs.filter("doc_id is not null")
        some = named.filter(~may_go).unionByName(named.filter(may_go).join(kept, F.col("doc_id") == F.col("of_doc"), "left_semi"))
    return some.unionByName(anonymous)


def signatures(text_col: str, words: int) -> Column:
    """The signature of each text's shingle set; null without shingles."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([signature(g) if len(g) else None for _, _, data, offs in text_slices(column)
                            for g in shingle_sets(data, offs, words)], pa.int64())

    return arrow_udf(tidy(run), "long")(F.col(text_col))


def classed(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(doc_id, sig, root, n_shingles, component_id) of every row; ``root`` is the signature that stands for its component."""
    ws = Workspace(docs.sparkSession, "ngram-join")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = ws.keep(fingerprints(docs, words, percent), "fingerprints")
    rows = prints.filter("piece is null").select("doc_id", "n", "sig")
    summaries = prints.filter("piece is null and sig is not null").select("sig", "n", "cells")
    counts = summed_sketch(prints.filter("piece is not null").select("piece", "cells"))

    classes = ws.keep(rows.filter("sig is not null").groupBy("sig").agg(F.max("n").alias("n"), F.min("doc_id").alias("least")), "classes")
    shared = ws.keep(shared_postings(postings(docs, counts, words, percent)), "shared").withColumn("head", index_posting(percent))
    ws.forget()

    def closest(links: DataFrame, name: str) -> DataFrame:
        links = ws.keep(links.distinct(), f"{name}-pairs")
        some = links.select(F.explode(F.array("a", "b")).alias("of")).distinct()
        known = ws.keep(summaries.join(some, F.col("sig") == F.col("of"), "left_semi").dropDuplicates(["sig"]), f"{name}-summaries")
        links = ws.keep(close(links, known, percent), name)
        ws.forget(f"{name}-pairs", f"{name}-summaries")
        return links

    clusters = connected_components(closest(candidates(shared, percent), "candidates"), ws, "clusters")
    labelled = shared.join(clusters.select(F.col("node"), F.col("root")), F.col("sig") == F.col("node"), "left").select(
        *shared.columns, F.coalesce("root", "sig").alias("label"))
    more = ws.keep(across(labelled, percent), "across")
    ws.forget("shared")
    more = closest(more.filter("not sure").select("a", "b"), "more").unionByName(more.filter("sure").select("a", "b"))
    if more.limit(1).count():
        clusters = connected_components(more.unionByName(clusters.toDF("a", "b")), ws, "all-clusters")
    clusters = clusters.withColumnRenamed("root", "cluster")
    members = ws.keep(clusters.join(classes, F.col("node") == F.col("sig")).select("cluster", "sig", "n", "least"), "members")
    sizes = members.groupBy(F.col("cluster").alias("of_cluster")).agg(
        F.greatest(F.ceil(F.count("*") / CHUNK_ROWS), F.ceil(F.sum("n") / CHUNK_SHINGLES)).cast("int").alias("chunks"))
    members = members.join(sizes, F.col("cluster") == F.col("of_cluster")).select(
        "cluster", "sig", "least", "chunks", F.pmod(F.xxhash64("sig"), F.col("chunks")).cast("int").alias("chunk"))
    # most documents are no candidates: their texts stay where they are, by a bitmap of the wanted ids
    wanted = may_hold(id_bits(members.filter("least is not null").select("least")), F.col("doc_id"), docs.sparkSession)
    texts = docs.filter("doc_id is not null").filter(wanted).join(members.hint("shuffle_hash"), F.col("doc_id") == F.col("least")).select(
        "cluster", "sig", "chunks", "chunk", "text")
    # classes whose rows all lack an id: one text of each by its signature
    lone = members.filter("least is null").select(F.col("sig").alias("lone"), "cluster", "chunks", "chunk")
    unnamed = (docs.filter("doc_id is null").select(signatures("text", words).alias("sig"), "text")
               .join(lone, F.col("sig") == F.col("lone")).dropDuplicates(["sig"]))
    texts = ws.keep(texts.unionByName(unnamed.select("cluster", "sig", "chunks", "chunk", "text")), "texts")

    # members by their narrow columns: labels travel to the tasks without the texts
    places = texts.select("cluster", "sig", "chunks", "chunk")
    alone = ["cluster", F.col("chunk").alias("task"), F.lit(0).alias("part"), F.lit(0).alias("side"), "chunk", F.lit(False).alias("last"), "sig"]
    found = ws.keep(verify(texts.select(*alone, "text"), places.limit(0).select(*alone, F.col("sig").alias("label")), words, percent), "within")
    large, large_places = texts.filter("chunks > 1"), places.filter("chunks > 1")
    if large_places.limit(1).count():
        def labelled(name: str) -> DataFrame:
            roots = connected_components(found, ws, name)
            return ws.keep(large_places.join(roots, F.col("sig") == F.col("node"), "left")
                           .select(*large_places.columns, F.coalesce("root", "sig").alias("label")), f"{name}-labels")

        now = labelled("round2")
        open_ = now.groupBy(F.col("cluster").alias("open")).agg(F.countDistinct("label").alias("n")).filter("n > 1").select("open")
        pick = lambda df: df.join(open_, F.col("cluster") == F.col("open"), "left_semi")
        found = ws.keep(found.unionByName(verify(to_first_chunk(pick(large), "text"), to_first_chunk(pick(now), "label"), words, percent)),
                        "with-first")
        now = labelled("round3")
        main = (now.groupBy("cluster", "label").count().groupBy(F.col("cluster").alias("of_cluster"))
                .agg(F.max_by("label", F.struct("count", "label")).alias("main")))
        rest = now.join(main, F.col("cluster") == F.col("of_cluster")).filter("label <> main").select(F.col("sig").alias("out_sig"), "of_cluster")
        rest = ws.keep(rest, "outside")
        if rest.limit(1).count():
            parts = rest.groupBy(F.col("of_cluster").alias("c")).agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("parts"))
            outside = ws.keep(rest.join(parts, F.col("of_cluster") == F.col("c")).select("out_sig", "of_cluster", "parts"), "parts")
            found = ws.keep(found.unionByName(verify(to_outsiders(large, outside, "text"), to_outsiders(now, outside, "label"), words, percent)),
                            "all-links")

    roots = connected_components(found, ws, "components").select(F.col("node"), "root")
    named = ws.keep(classes.join(roots, F.col("sig") == F.col("node"), "left")
                    .select("sig", "least", F.coalesce("root", "sig").alias("root")), "named")
    component = named.groupBy(F.col("root").alias("of_root")).agg(F.min("least").alias("component_id"))
    named = ws.keep(named.join(component, F.col("root") == F.col("of_root")).select(F.col("sig").alias("of_sig"), "root", "component_id"), "result")
    return rows.join(named, F.col("sig") == F.col("of_sig"), "left").select(
        "doc_id", "sig", "root", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
