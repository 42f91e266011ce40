"""Quality classifier: random Fourier features, ridge regression from summed normal equations, isotonic calibration.

A text becomes a few statistics of its whole length (numpy over byte buffers).
Random cosines of the standardised statistics approximate a Gaussian kernel;
each partition of the labelled rows adds up Z'Z and Z'y, the sums meet in two
streaming levels, and one small solve gives the ridge weights. A fold of the
training rows that the fit has not seen calibrates the scores: labels are summed
per score bin (a fixed number of bins) and pooled to a monotone map.

Defined cases: null and empty texts have all-zero counts and get a score like
any other; labels other than 0 and 1, or of unknown ids, are not learnt from; a
repeated label or document counts each time; without any label every score is
0.5. Only the named id, text and label columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from touchcredit.llm.common import tidy

from touchcredit.llm.textscan import IS_SPACE, find_words, hash_words, mix64, row_of, segment_sum, text_slices

COSINES = 256
RIDGE = 1.0
SEED = 20
BINS = 4000

FEATURES = ("log_words", "word_length", "upper", "digits", "stops", "shouts", "pipes", "symbols", "other_marks", "non_ascii",
            "lines", "distinct_words", "top_word", "repeated_pairs", "capitalised", "marked_words")

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LETTER = _UPPER | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_DIGIT = (_B >= 48) & (_B <= 57)
_STOP = np.isin(_B, [ord(c) for c in ".,;:?"])
_SYMBOL = np.isin(_B, [ord(c) for c in "#$%&*@^~<>{}[]=+\\_/`"])
_OTHER = (_B > 32) & (_B < 127) & ~_LETTER & ~_DIGIT & ~_STOP & ~_SYMBOL & (_B != 33) & (_B != 124)


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES per text of a slice."""
    rows = len(offs) - 1
    starts, ends, at = find_words(data, offs)
    words, row = np.diff(at).astype(np.float64), row_of(at)
    per_word = 1.0 / np.maximum(words, 1)

    def count(table: np.ndarray) -> np.ndarray:
        return segment_sum(table[data], offs).astype(np.float64)

    chars = count(~IS_SPACE)
    letters, upper = count(_LETTER), count(_UPPER)
    distinct, top, pairs = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    if len(starts):
        h = hash_words(data, starts, ends)
        # rows in the high bits, hashes in the rest: one sort groups equal words of a text
        for into, code, of in ((distinct, h, row), (pairs, mix64(h[:-1] ^ (h[1:] << np.uint64(1))), row[:-1])):
            if into is pairs:
                inside = row[1:] == row[:-1]
                code, of = code[inside], of[inside]
            if not len(code):
                continue
            key = np.sort((of.astype(np.uint64) << np.uint64(40)) | (code >> np.uint64(24)))
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            run, of_run = np.diff(np.append(first, len(key))), (key[first] >> np.uint64(40)).astype(np.int64)
            into += np.bincount(of_run, minlength=rows)
            if into is distinct:
                np.maximum.at(top, of_run, run)
        first_upper = segment_sum(_UPPER[data[starts]], at)
        last = data[ends - 1]
        marked = segment_sum((_SYMBOL | (_B == 33))[last], at)
    else:
        first_upper = marked = np.zeros(rows)
    per_char = 1.0 / np.maximum(chars, 1)
    return np.stack([
        np.log1p(words), np.log1p(chars * per_word), np.sqrt(upper / np.maximum(letters, 1)), np.sqrt(count(_DIGIT) * per_char),
        np.sqrt(count(_STOP) * per_word), np.log1p(count(_B == 33) * per_word), np.log1p(count(_B == 124) * per_word),
        np.log1p(count(_SYMBOL) * per_word), np.log1p(count(_OTHER) * per_word), np.sqrt(count(_B >= 128) * per_char),
        np.sqrt(count(_B == 10) * per_word), np.sqrt(distinct * per_word), np.sqrt(top * per_word),
        np.sqrt(np.maximum(words - 1 - pairs, 0) * per_word), np.sqrt(first_upper * per_word), np.sqrt(marked * per_word)], axis=1)


def features(text: Column) -> Column:
    """array<double> of FEATURES of a text column."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            got = [statistics(data, offs) for _, _, data, offs in text_slices(column)]
            flat = np.concatenate(got).ravel() if got else np.zeros(0)
            offs = np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offs), pa.array(flat))

    return arrow_udf(tidy(run), "array<double>")(text)


def _summed(rows: DataFrame, size: int, add) -> np.ndarray:
    """Sum of ``add(values, labels)`` (flat, of length ``size``) over all batches: per partition, then 32 to 1."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            total += add(x, batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for blob in batch.column(0):
                total += np.frombuffer(blob.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = rows.mapInArrow(tidy(first), "sums binary").repartition(32).mapInArrow(tidy(more), "sums binary")
    total = np.zeros(size)
    for r in parts.coalesce(1).mapInArrow(tidy(more), "sums binary").collect():      # one row
        total += np.frombuffer(bytes(r[0]))
    return total


def fourier(x: np.ndarray, model: dict) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["std"], -6, 6)
    return np.hstack([np.sqrt(2.0 / COSINES) * np.cos(z @ model["w"] + model["b"]), np.ones((len(x), 1))])


def pool_adjacent(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of means y/n at ascending x: (weighted centre, value) of each pooled block."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, n):
        blocks.append([a * c, b, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(labelled: DataFrame, ridge: float = RIDGE) -> dict:
    """Model from rows (features, label double, calibrate boolean)."""
    d = len(FEATURES)
    rng = np.random.default_rng(SEED)
    model = {"w": rng.normal(size=(d, COSINES)) / np.sqrt(d), "b": rng.uniform(0, 2 * np.pi, COSINES)}
    train = labelled.filter("not calibrate").select("features", "label")
    s = _summed(train, 2 * d + 1, lambda x, y: np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]]))
    n = s[-1]
    if not n:
        return {}
    model["mean"] = s[:d] / n
    model["std"] = np.sqrt(np.maximum(s[d:2 * d] / n - model["mean"] ** 2, 1e-12)) + 1e-3
    m = COSINES + 1

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier(x, model)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    s = _summed(train, m * m + m, normal)
    penalty = np.diag(np.append(np.full(COSINES, ridge), 1e-6))
    model["beta"] = np.linalg.solve(s[:m * m].reshape(m, m) + penalty, s[m * m:])

    def bins(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip((fourier(x, model) @ model["beta"] + 1) / 3 * BINS, 0, BINS - 1).astype(np.int64)
        return np.concatenate([np.bincount(at, weights=y, minlength=BINS), np.bincount(at, minlength=BINS)])

    s = _summed(labelled.filter("calibrate").select("features", "label"), 2 * BINS, bins)
    if not s[BINS:].sum():                       # nothing held back: calibrate on what was fitted
        s = _summed(train, 2 * BINS, bins)
    seen = np.flatnonzero(s[BINS:])
    model["x"], model["y"] = pool_adjacent((seen + 0.5) / BINS * 3 - 1, s[:BINS][seen], s[BINS:][seen])
    return model


def probability(x: np.ndarray, model: dict) -> np.ndarray:
    """Calibrated score; one hundredth comes from the raw score, so that pooled ties keep their order."""
    if not model:
        return np.full(len(x), 0.5)
    raw = fourier(x, model) @ model["beta"]
    return 0.99 * np.interp(raw, model["x"], model["y"]) + 0.01 / (1 + np.exp(-4 * (raw - 0.5)))


def score(column: Column, model: dict) -> Column:
    """Score of a ``features`` column. The model is a few matrices of fixed size."""
    packed = pickle.dumps(model)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = pickle.loads(packed)
        for c in columns:
            yield pa.array(probability(c.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)), m))

    return arrow_udf(tidy(run), "double")(column)


def labelled(feats: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """Training rows: documents outside fold 0 with a 0/1 label; fold 1 calibrates. ``feats``: (doc_id, fold, features)."""
    told = labels.select(F.col(id_col).alias("of_doc"), F.col(label_col).cast("double").alias("label")).filter("label in (0, 1)")
    return (feats.filter("fold <> 0").join(told, F.col("doc_id") == F.col("of_doc"))
            .select("features", "label", (F.col("fold") == 1).alias("calibrate")))
