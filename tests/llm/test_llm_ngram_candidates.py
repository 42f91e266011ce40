"""Candidates of the n-gram join: none of unrelated texts, however long or many, and no near pair lost."""

from __future__ import annotations

import pickle
import random
import sys
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import helpers as H  # noqa: E402

from touchcredit.llm import bpe, ngram_join  # noqa: E402
from touchcredit.llm.common import Workspace, ensure_importable, tidy  # noqa: E402


def passage(name, n):
    return [f"{name}w{k}" for k in range(n)]


@pytest.fixture
def kept(monkeypatch):
    """Rows of the tables that an operator writes, by name."""
    rows, keep = {}, Workspace.keep

    def counted(self, df, name):
        rows[name] = (out := keep(self, df, name)).count()
        return out

    monkeypatch.setattr(Workspace, "keep", counted)
    return rows


def test_unrelated_texts_are_no_candidates(spark, kept):
    """Texts whose every shingle is shared: long ones with one passage in common, and many short ones of a few passages."""
    ensure_importable(spark)
    rng = random.Random(4)
    shared = {p: passage(f"p{p[0]}x{p[1]}", 1300) for p in combinations(range(10), 2)}
    rows = [(i, " ".join(w for p, words in shared.items() if i in p for w in words), "en", "s") for i in range(10)]
    pool = [passage(f"q{k}", 40) for k in range(10)]
    rows += [(100 + k, " ".join(w for part in parts for w in pool[part]), "en", "s")
             for k, parts in enumerate(rng.sample(list(combinations(range(10), 5)), 160))]
    got = ngram_join.near_duplicates(H.documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter(H.jaccard_components(rows))
    assert kept["texts"] < 20


class Stream:
    """Stands for sorted postings: feeds batches of a few rows to a mapInArrow function."""

    def __init__(self, rows, step):
        self.rows, self.step = sorted(rows), step

    def repartition(self, *columns):
        return self

    def sortWithinPartitions(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        types = {"gram": pa.int64(), "n": pa.int32(), "sig": pa.int64(), "pos": pa.int32(), "head": pa.bool_(), "label": pa.int64()}

        def batches():
            for at in range(0, len(self.rows), self.step):
                part = list(zip(*self.rows[at:at + self.step]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types.values())], names=list(types))
        return [tuple(r) for b in run(batches()) for r in zip(*(c.to_pylist() for c in b.columns))]


@pytest.mark.parametrize("step", [1, 2, 5, 1000])
def test_streams_across_labels_lose_no_pair(step, monkeypatch):
    """Pairs of large groups that pass the filters stay connected, listed or by chains, in groups across batches."""
    rng = random.Random(step)
    for _ in range(40):
        small, many = rng.choice([(2, 4), (3, 3), (2, 1000), (5, 7)])
        monkeypatch.setattr(ngram_join, "GROUP_PAIRS", small)
        monkeypatch.setattr(ngram_join, "MANY_PAIRS", many)
        n = {s: rng.randint(4, 30) for s in range(40)}
        label = {s: rng.choice([s, s, s % 3]) for s in n}
        rows = []
        for g in range(rng.randint(1, 25)):
            for s in rng.sample(range(40), rng.choice([2, 3, 4, 9, 15])):
                pos = rng.randint(0, n[s] // 4)
                rows.append((g, n[s], s, pos, pos <= n[s] - -(-170 * n[s] // 185), label[s]))
        part = {s: label[s] + 100 for s in n}            # sets of one label are connected already
        part |= {x + 100: x + 100 for x in label.values()}

        def find(x):
            while part[x] != x:
                x = part[x]
            return x

        alike = set()
        for a, b, sure in ngram_join.across(Stream(rows, step), 85):
            assert label[a] != label[b]
            alike |= set() if sure else {(a, b)}
            part[find(a)] = find(b)
        size = Counter(r[0] for r in rows)
        near = lambda x, y: 100 * x[1] >= 85 * y[1] and min(x[1] - x[3], y[1] - y[3]) >= -(-85 * (x[1] + y[1]) // 185)
        pairs = [(x, y) for k, x in enumerate(sorted(rows)) for y in sorted(rows)[k + 1:] if x[0] == y[0] and size[x[0]] > small and near(x, y)]
        assert all(find(x[2]) == find(y[2]) for x, y in pairs)
        assert alike <= {(x[2], y[2]) for x, y in pairs}


def test_summaries_of_different_width_bound_the_intersection():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 62, 60_000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, k)) for k in (1, 5, 300, 3000, 30_000)]
    of = lambda s, cells: np.frombuffer(ngram_join.summary(s, cells), dtype=np.uint8)[None]
    for a, b in combinations(sets, 2):
        for left, right in ((16, 16), (16, 64), (1024, 128), (64, 4096)):
            assert ngram_join.shared_at_most(of(a, left), of(b, right))[0] >= len(np.intersect1d(a, b))


def test_deduplicate_with_a_full_bitmap(spark, monkeypatch):
    """Bits that ids share send a kept document to the join, which keeps it."""
    ensure_importable(spark)
    rows = [(k, f"{'near' if k % 3 else 'far'} {k // 3 if k % 3 else k} " + " ".join(passage(k // 3 if k % 3 else k, 30)), "en", "s") for k in range(60)]
    rows += [(100 + k, " ".join(passage("c", 60)[:59 + k % 2]), "en", "s") for k in range(5)] + [(None, "a text without an id", "en", "s")]
    docs = H.documents(spark, rows)
    want = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in ngram_join.deduplicate(docs).collect())
    assert {i for i, _ in want} == {c for i, _, c in H.jaccard_components(rows) if i is not None} | {-1}
    monkeypatch.setattr(ngram_join, "ID_BITS", 3)
    monkeypatch.setattr(ngram_join, "ID_PIECE_BITS", 3)
    assert want == sorted((-1 if r["doc_id"] is None else r["doc_id"], r["text"]) for r in ngram_join.deduplicate(docs).collect())


def test_near_pairs_pass_at_every_size(spark):
    """A pair at the threshold passes the summaries of any size; unrelated sets of its size do not."""
    ensure_importable(spark)
    rng = np.random.default_rng(1)
    sets, links, wanted = [], [], set()
    for n in (9, 60, 400, 3000, 12_000):
        a, other = (rng.integers(0, 1 << 62, n).astype(np.uint64) for _ in range(2))
        common = -(-2 * 80 * n // 180)                   # the least of equal sizes
        b = np.concatenate([a[:common], rng.integers(0, 1 << 62, n - common).astype(np.uint64)])
        at = len(sets)
        sets += [a, b, other]
        links += [(at, at + 1), (at + 2, at)]
        wanted |= {(at, at + 1)}
    summaries = spark.createDataFrame([(i, len(s), bytearray(ngram_join.summary(s, ngram_join.summary_cells(len(s), 80)))) for i, s in enumerate(sets)],
                                      "sig long, n long, cells binary")
    got = ngram_join.close(spark.createDataFrame(links, "a long, b long").repartition(2, F.col("a")), summaries, 80)
    assert {(r["a"], r["b"]) for r in got.collect()} == wanted


def test_tasks_of_other_stages_drop_the_encoder(monkeypatch):
    """A worker that goes on to another stage lets the encoder and its words go; one of the same stage keeps them."""
    monkeypatch.setitem(bpe._codecs, "key", object())

    def run(batches):
        yield from batches

    run.__module__ = bpe.__name__
    assert list(pickle.loads(cloudpickle.dumps(tidy(run)))([1])) == [1] and "key" in bpe._codecs
    run.__module__ = ngram_join.__name__
    assert list(pickle.loads(cloudpickle.dumps(tidy(run)))([1])) == [1] and "key" not in bpe._codecs
