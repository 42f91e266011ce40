"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of the lower-cased text per language in
each partition (numpy), adds them up over partitions, and broadcasts the
smoothed log-probability matrix. Prediction gathers the matrix rows of a batch's
n-grams and sums them per text, in pieces of bounded size. Runs of characters
that are not letters count as one space.

A matrix holds as many languages as ``MATRIX_BYTES`` allows. Should a column
have more, the languages are taken in slices by code, one matrix and one pass
over the texts each; every text carries its best language so far and the log
sum of all likelihoods, so the result is that of one matrix of them all. Texts
of any length are scanned in pieces, with the n-grams across their borders.

Defined cases: null text, or text without a letter, is ``und`` with score 0; so
is every text if there is nothing to learn from. Languages tie to the smallest
code. Rows without a language or text are not learnt from. Repeated rows count
each time they occur. Columns other than those named are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from touchcredit.llm.common import Workspace, free_name, tidy

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
#: A broadcast matrix: buckets x languages x 4 bytes stay below this.
MATRIX_BYTES = 64 << 20
#: Matrix rows gathered at a time.
GATHER_BYTES = 16 << 20
#: Languages counted densely by a task at a time.
DENSE_LANGUAGES = 64
SLICE_CHARS = 1 << 18

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


_HASH = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]


def ngrams(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram order: (bucket of each n-gram, row of each n-gram), rows ascending."""
    joined = "\x00".join(t.replace("\x00", " ") for t in texts).lower()
    cp = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letter_table()[cp]
    edge = cp == 0
    row = np.cumsum(edge)
    keep = letter | edge
    keep[1:] |= letter[:-1] & ~edge[1:]        # first of a run of other characters, after a letter
    cp = np.where(letter | edge, cp, np.uint32(32))[keep]
    row, edge, letter = row[keep], edge[keep], letter[keep]
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    code = cp * _HASH[0]
    code ^= code >> np.uint32(15)
    for n in ORDERS:
        m = len(cp) - n + 1
        if m <= 0:
            return
        h = np.full(m, n, dtype=np.uint32) * _HASH[2]
        good = np.ones(m, dtype=bool)
        some = np.zeros(m, dtype=bool)
        for k in range(n):
            h = (h ^ code[k:k + m]) * _HASH[1]
            h ^= h >> np.uint32(13)
            good &= ~edge[k:k + m]
            some |= letter[k:k + m]
        good &= some
        yield ((h * _HASH[0]) >> shift)[good].astype(np.int64), row[:m][good]


def long_ngrams(text: str, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(n-gram order from 0, buckets) of one long text, piece by piece; each piece starts with the end of the one before."""
    low = text.replace("\x00", " ").lower()
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    tail, tail_letter, after_letter = np.zeros(0, np.uint32), np.zeros(0, bool), False
    for at in range(0, len(low), SLICE_CHARS):
        cp = np.frombuffer(low[at:at + SLICE_CHARS].encode("utf-32-le", "replace"), dtype=np.uint32)
        letter = _letter_table()[cp]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= after_letter
        after_letter = bool(letter[-1])
        cp = np.concatenate([tail, np.where(letter, cp, np.uint32(32))[keep]])
        letter = np.concatenate([tail_letter, letter[keep]])
        code = cp * _HASH[0]
        code ^= code >> np.uint32(15)
        for n in ORDERS:
            first = max(0, len(tail) - n + 1)              # those before have been seen
            m = len(cp) - n + 1 - first
            if m <= 0:
                continue
            h = np.full(m, n, dtype=np.uint32) * _HASH[2]
            some = np.zeros(m, dtype=bool)
            for k in range(first, first + n):
                h = (h ^ code[k:k + m]) * _HASH[1]
                h ^= h >> np.uint32(13)
                some |= letter[k:k + m]
            yield n - 1, ((h * _HASH[0]) >> shift)[some].astype(np.int64)
        last = max(ORDERS) - 1
        tail, tail_letter = cp[-last:], letter[-last:]


def grams(texts: list[str], buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n-gram order from 0, buckets, rows ascending) of some texts, or of a long one in pieces."""
    if len(texts) == 1 and len(texts[0]) > SLICE_CHARS:
        for order, bucket in long_ngrams(texts[0], buckets):
            yield order, bucket, np.zeros(len(bucket), dtype=np.int64)
    else:
        for order, (bucket, row) in enumerate(ngrams(texts, buckets)):
            yield order, bucket, row


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end] or "") <= SLICE_CHARS):
            chars += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


class Model:
    """Counts of n-grams by language as a table (lang, bucket, n), where bucket -1 counts texts; read in slices of languages."""

    def __init__(self, counts: DataFrame, buckets: int):
        self.counts, self.buckets = counts, buckets
        texts, languages = counts.filter("bucket = -1").agg(F.sum("n"), F.count("*")).first()
        self.texts = int(texts or 0)
        self.per_slice = max(1, MATRIX_BYTES // (4 * buckets))
        self.slices = max(1, -(-languages // self.per_slice))

    def parts(self) -> Iterator[dict]:
        """One {"langs": codes in order, "logp": float32 (buckets, languages), "prior": log priors} per slice."""
        last = None
        for _ in range(self.slices):
            more = self.counts if last is None else self.counts.filter(F.col("lang") > last)
            langs = [r["lang"] for r in more.filter("bucket = -1").select("lang").orderBy("lang").limit(self.per_slice).collect()]
            if langs:
                last = langs[-1]
                more = more.filter(F.col("lang") <= last)
            yield self.matrix(langs, more.toArrow() if langs else None)   # (buckets + 1) x per_slice rows at most

    def matrix(self, langs: list[str], got: pa.Table | None) -> dict:
        table, prior = np.full((self.buckets, len(langs)), SMOOTHING), np.zeros(len(langs))
        if not langs:
            return {"langs": langs, "logp": table, "prior": prior}
        place = {x: i for i, x in enumerate(langs)}
        of = np.array([place[x] for x in got["lang"].to_pylist()], dtype=np.int64)
        bucket, n = got["bucket"].to_numpy(), got["n"].to_numpy()
        at = bucket >= 0
        table[bucket[at], of[at]] += n[at]
        prior[of[~at]] = n[~at]
        return {"langs": langs, "logp": np.log(table / table.sum(axis=0)).astype(np.float32), "prior": np.log(prior / self.texts)}


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS) -> Model:
    """The model of the rows with a language and a text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def told(x: str, at: np.ndarray, n: np.ndarray, texts: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int64()),
                                               pa.array(np.append(n, texts), pa.int64())], names=["lang", "bucket", "n"])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, end in slices(texts):
                code = {x: i for i, x in enumerate(dict.fromkeys(langs[at:end]))}
                of = np.array([code[x] for x in langs[at:end]], dtype=np.int64)
                dense = len(code) <= DENSE_LANGUAGES
                got = np.zeros(len(code) * buckets if dense else 0, dtype=np.int64)
                sparse = []
                for _, bucket, row in grams(texts[at:end], buckets):
                    if dense:
                        got += np.bincount(of[row] * buckets + bucket, minlength=len(got))
                    else:
                        sparse.append(np.unique(of[row] * buckets + bucket, return_counts=True))
                texts_of = np.bincount(of, minlength=len(code))
                if not dense:                  # many languages: their counts go out as they are
                    key, n = (np.concatenate(x) for x in zip(*sparse)) if sparse else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    names = np.array(list(code), dtype=object)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([names[key // buckets], names]), pa.string()),
                         pa.array(np.concatenate([key % buckets, np.full(len(names), -1)]), pa.int64()),
                         pa.array(np.concatenate([n, texts_of]), pa.int64())], names=["lang", "bucket", "n"])
                    continue
                for x, i in code.items():
                    if x not in sums:
                        sums[x] = np.zeros(buckets, dtype=np.int64)
                    sums[x] += got[i * buckets:(i + 1) * buckets]
                    rows[x] = rows.get(x, 0) + int(texts_of[i])
                if len(sums) > DENSE_LANGUAGES:
                    for x, c in sums.items():
                        yield told(x, np.flatnonzero(c), c[c > 0], rows[x])
                    sums.clear()
                    rows.clear()
        for x, c in sums.items():
            yield told(x, np.flatnonzero(c), c[c > 0], rows[x])

    seen = (docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")))
    counts = (seen.mapInArrow(tidy(count), "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    return Model(Workspace(docs.sparkSession, "language").keep(counts, "counts"), buckets)


def likelihoods(docs: DataFrame, part: dict, text_col: str) -> Column:
    """Per text: (whether it has a letter, best language of the part or null, its log likelihood, log sum of all)."""
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(part))

    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = pickle.loads(sent.value)
        langs, logp, prior = m["langs"], m["logp"], m["prior"]
        step = max(1, GATHER_BYTES // (4 * max(1, len(langs))))
        for column in columns:
            texts = column.to_pylist()
            n = len(texts)
            known, best, top, every = np.zeros(n, dtype=bool), [None] * n, np.full(n, -np.inf), np.full(n, -np.inf)
            for at, end in slices(texts) if langs else ():
                # few texts at a time where there are many languages
                for lo in range(at, end, rows := max(1, step // 2)):
                    hi = min(end, lo + rows)
                    total = np.tile(prior, (hi - lo, 1))
                    for order, bucket, row in grams([t or "" for t in texts[lo:hi]], len(logp)):
                        for k in range(0, len(row), step):
                            r = row[k:k + step]
                            first = np.flatnonzero(np.diff(r, prepend=-1))
                            total[r[first]] += np.add.reduceat(logp[bucket[k:k + step]], first, axis=0, dtype=np.float64)
                            if order == 0:             # 1-grams are the letters
                                known[lo + r[first]] = True
                    pick = total.argmax(axis=1)        # the first of equals: the smallest code
                    top[lo:hi] = total[np.arange(hi - lo), pick]
                    every[lo:hi] = top[lo:hi] + np.log(np.exp(total - top[lo:hi, None]).sum(axis=1))
                    best[lo:hi] = [langs[i] for i in pick]
            yield pa.StructArray.from_arrays([pa.array(known), pa.array(best, pa.string()), pa.array(top), pa.array(every)],
                                             names=["known", "lang", "best", "every"])

    return arrow_udf(tidy(score), "known boolean, lang string, best double, every double")(F.col(text_col))


def predict(docs: DataFrame, model: Model, text_col: str = "text", into: str = "language") -> DataFrame:
    """The rows of ``docs`` with a struct ``into``: ``lang_pred`` and its posterior ``score``."""
    so_far, more = free_name(docs, "so_far"), free_name(docs, "more_languages")
    out, ws = docs, None
    for i, part in enumerate(model.parts()):
        if i == 0:
            out = out.withColumn(so_far, likelihoods(docs, part, text_col))
            continue
        ws = ws or Workspace(docs.sparkSession, "languages")
        out = ws.keep(out, f"slice{i}").withColumn(more, likelihoods(docs, part, text_col))
        a, b = F.col(so_far), F.col(more)
        high, low = F.greatest(a["every"], b["every"]), F.least(a["every"], b["every"])
        # languages of earlier slices have smaller codes: they win ties
        out = out.withColumn(so_far, F.struct(
            a["known"].alias("known"), F.when(b["best"] > a["best"], b["lang"]).otherwise(a["lang"]).alias("lang"),
            F.greatest(a["best"], b["best"]).alias("best"), (high + F.log1p(F.exp(low - high))).alias("every"))).drop(more)
    got = F.col(so_far)
    found = got["known"] & got["lang"].isNotNull()
    kept = [c for c in docs.columns if c != into]
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(
        F.when(found, got["lang"]).otherwise("und").alias("lang_pred"),
        F.when(found, F.exp(got["best"] - got["every"])).otherwise(0.0).alias("score")).alias(into))
