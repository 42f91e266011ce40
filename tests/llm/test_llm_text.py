"""Operators over documents: brute force, round trips, held-out accuracy and hard cases."""

from __future__ import annotations

import base64
import hashlib
import math
import pickle
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import helpers as H  # noqa: E402

from touchcredit.llm import bpe, language, mixing, ngram_join, quality, queries, suffix_tree, textscan  # noqa: E402
from touchcredit.llm.common import ensure_importable  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hard(spark):
    ensure_importable(spark)
    return H.hard_documents()


@pytest.fixture(scope="module")
def hard_df(spark, hard):
    return H.documents(spark, hard).repartition(3).cache()


def close(a, b):
    return abs(a - b) <= 1e-6 * max(1.0, abs(b))


def test_scanner_matches_regular_expression(hard):
    texts = [r[1] for r in hard] + ["a\x0bb\x1cc\x85d e", "É é\x00z", "\x09\x0a\x0b\x0c\x0d "]
    seen = {}
    for size in (1, 40, 1 << 20):
        for first, end, data, offs in textscan.text_slices(pa.array(texts, pa.string()), size):
            starts, ends, at = textscan.find_words(data, offs)
            hashes = textscan.hash_words(data, starts, ends)
            for r in range(first, end):
                expect = H.words(texts[r])
                got = hashes[at[r - first]:at[r - first + 1]]
                assert len(got) == len(expect)
                for w, h in zip(expect, got.tolist()):
                    assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# -- 1 mixing -------------------------------------------------------------------------------------------

def oracle(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df)
    return con.sql(sql).df()


def sorted_rows(df, columns):
    key = lambda r: tuple((x is None or x != x, "" if x is None or x != x else x) for x in r)
    return sorted((tuple(None if x != x else x for x in r) for r in df[columns].itertuples(index=False)), key=key)


@pytest.mark.parametrize("block_words", [7, 4096])
def test_mixing_matches_sql(hard, hard_df, block_words):
    got = mixing.mix(hard_df, block_words=block_words).toPandas()
    table = pd.DataFrame([r[:4] for r in hard], columns=["doc_id", "text", "lang", "source"]).astype({"doc_id": "Int64"})
    expect = oracle(queries.OP1_SQL, documents=table)
    # rows of one id and size are interchangeable
    columns = ["doc_id", "size", "source_size", "target", "taken", "source"]
    assert sorted_rows(got.astype(object).where(got.notna(), None), columns) == sorted_rows(expect.astype(object).where(expect.notna(), None), columns)
    assert (got["taken"] <= 3 * got["size"]).all()
    for _, g in got.groupby("source", dropna=False):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) < 1


def test_schedule_is_low_discrepancy(spark, hard_df):
    quota = spark.createDataFrame([("a", 90_000, 30_000.0), ("b", 90_000, 60_000.0), (None, 90_000, 90_000.0)],
                                  "source string, source_size long, target double")
    slots = mixing.schedule(quota, 100).orderBy("slot").toPandas()
    assert len(slots) == 1800 and slots["words"].sum() == 180_000
    for n in (60, 300, 900, 1500):
        share = slots["source"].iloc[:n].fillna("null").value_counts() / n
        for s, x in (("a", 1 / 6), ("b", 2 / 6), ("null", 3 / 6)):
            assert abs(share[s] - x) < 12 / n
    ranks = slots.sort_values("slot").groupby(slots["source"].fillna("null"))["rank"]
    assert all(list(r) == list(range(len(r))) for _, r in ranks)


def test_mixing_empty(hard_df):
    assert mixing.mix(hard_df.limit(0)).count() == 0
    assert set(mixing.mix(hard_df.filter("doc_id in (200, 201)")).toPandas()["taken"]) == {0}


# -- 3 suffix tree ----------------------------------------------------------------------------------------

def test_suffix_tree_counts_and_base(hard, hard_df):
    got = suffix_tree.score_documents(hard_df).toPandas()
    key = lambda r: (r[0] is None or r[0] != r[0], r[0] or 0, r[1], r[4])
    rows = sorted(((None if i != i else int(i), a, b, n, s) for i, a, b, n, s in
                   got[["doc_id", "n_tokens", "n_known", "train_tokens", "base_score"]].itertuples(index=False)), key=key)
    expect = sorted(H.base_scores(hard), key=key)
    assert len(rows) == len(expect)
    for a, b in zip(rows, expect):
        assert a[:4] == b[:4] and close(a[4], b[4])
    assert np.isfinite(got["score"]).all() and (got["score"] <= 1e-9).all()


def test_suffix_tree_learns_contexts(spark):
    """On text with strong order the tree beats its own root."""
    ensure_importable(spark)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(200):
        w = ["w0"]
        for _ in range(100):
            w.append(f"w{(int(w[-1][1:]) * 3 + (rng.random() < 0.1)) % 7}")
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    deep = suffix_tree.score(docs, F.col("doc_id") >= 20, p_min=1e-3).filter("doc_id < 20").agg(F.sum("score")).first()[0]
    flat = suffix_tree.score(docs, F.col("doc_id") >= 20, depth=0).filter("doc_id < 20").agg(F.sum("score")).first()[0]
    assert deep > 0.6 * flat


def test_suffix_tree_distributions_sum_to_one():
    """Directly on a packed block: root and states, over every known word plus the unknown symbol."""
    rng = np.random.default_rng(3)
    words = np.sort(rng.integers(1, 1 << 62, 6).astype(np.uint64))
    counts = np.array([40, 30, 15, 10, 4, 1])
    n, v, d = int(counts.sum()), 6, 0.4
    one = suffix_tree.extend(np.zeros(1, np.uint64), words[:1])
    model = {"n": n, "v": v, "discount": d, "words": words, "counts": counts, "levels": [np.sort(one)], "states": one,
             "share": np.array([0.3]), "pairs": np.sort(suffix_tree.follow(one, words[1:3])), "extra": np.array([0.5, 0.2])}
    unknown = np.uint64(12345)
    every = np.append(words, unknown)
    codes = np.concatenate([[0, k] for k in range(7)]).astype(np.int32)
    b = suffix_tree.Block({"block": 0, "ids": pickle.dumps([0] * 7), "train": np.ones(7, bool).tobytes(), "lengths": np.full(7, 2).astype(np.int64).tobytes(),
                           "words": every.tobytes(), "codes": zlib.compress(codes.tobytes())})
    _, p = suffix_tree.probabilities(b, model)
    mass = d * v / n
    after = p[1::2].copy()
    after[6] *= mass                                   # the unknown word's root probability
    assert abs(after.sum() - 1) < 1e-12
    assert abs(sum((c - d) / n for c in counts) + mass - 1) < 1e-12


def plain_tree(texts, train, seen, depth, gamma=suffix_tree.GAMMA, divergence=suffix_tree.DIVERGENCE):
    """log10 probability of every text by dictionaries over whole texts, and the retained contexts."""
    tokens = [H.words(t) + [None] for t in texts]
    learnt = [t for t, use in zip(tokens, train) if use]
    c = Counter(w for t in learnt for w in t)
    n, v = sum(c.values()), len(c)
    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
    size, after, states = {(w,): x for w, x in c.items() if w is not None and x >= seen}, {}, {}
    heads = {w for w, in size}

    def parent(context, k):
        for j in range(k - 1, 0, -1):
            if context[-j:] in states:
                return context[-j:]
        return ()

    for k in range(1, depth + 1):
        if k > 1:
            found = Counter(tuple(t[i - k:i]) for t in learnt for i in range(k, len(t)))
            size.update({x: m for x, m in found.items() if m >= seen and set(x) <= heads and x[1:] in size and x[:-1] in size})
        for t in learnt:
            for i in range(k, len(t)):
                x = tuple(t[i - k:i])
                if x in size:
                    after.setdefault(x, Counter())[t[i]] += 1
        for x in [x for x in size if len(x) == k]:
            above = parent(x, k)
            kl = q_rest = p_rest = 0.0
            q_rest = p_rest = 1.0
            symbols = 0
            for w, m in after[x].items():
                if m >= gamma * size[x]:
                    q = m / size[x]
                    p = (after[above][w] if after[above][w] > 1 else 1) / size[above] if above else c[w] / n
                    kl, q_rest, p_rest, symbols = kl + q * math.log(q / p), q_rest - q, p_rest - p, symbols + 1
            q_rest, p_rest = max(q_rest, 1e-12), max(p_rest, 1e-12)
            if kl + q_rest * math.log(q_rest / p_rest) - symbols / (2 * size[x]) >= divergence:
                states[x] = 0.98 / (size[x] + len(after[x]))
    scores = []
    for t in tokens:
        total = 0.0
        for i, w in enumerate(t):
            p = (c[w] - d) / n if c[w] else d * v / n
            for k in range(1, min(depth, i) + 1):
                x = tuple(t[i - k:i])
                if x not in size:
                    break
                if x in states:
                    p = (after[x][w] if after[x][w] > 1 else 0) * states[x] + (1 - states[x] * sum(m for m in after[x].values() if m > 1)) * p
            total += math.log10(p)
        scores.append(total)
    return scores, states


@pytest.mark.parametrize("seed,depth", [(1, 3), (2, 2), (3, 1)])
def test_suffix_tree_against_plain_tree(spark, seed, depth):
    """Retained contexts and scores on random texts with order, repeats, unknown words and empty texts."""
    ensure_importable(spark)
    rng = random.Random(seed)
    texts = []
    for i in range(120):
        w = [rng.randint(0, 11)]
        for _ in range(rng.randint(0, 60)):
            w.append((w[-1] * 5 + (w[-2] if len(w) > 1 and rng.random() < 0.5 else 0) + (rng.random() < 0.2)) % 12)
        texts.append(" ".join(f"W{x}" if rng.random() < 0.3 else f"w{x}" for x in w) + (f" only{i}" if i % 9 == 0 else ""))
    texts += ["", None, "w1", "the same line again", "the same line again"] + ["the same line again"] * 20
    train = [i % 4 != 0 for i in range(len(texts))]
    want, states = plain_tree(texts, train, 10, depth)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in suffix_tree.score(docs, F.col("doc_id") % 4 != 0, depth=depth, seen=10).collect()}
    assert len(states) > 5 and len({len(x) for x in states}) == depth
    assert all(close(got[i], x) for i, x in enumerate(want))


def test_suffix_tree_drops_repeated_contexts(spark):
    """A context whose followers are those of its suffix is no state, however it is smoothed."""
    texts = [f"x{i % 2} b f{i // 2 % 50}" for i in range(3000)]
    _, states = plain_tree(texts, [True] * 3000, 100, 2)
    assert ("b",) in states and not any(len(x) == 2 and x[1] == "b" for x in states)


def test_suffix_tree_packets():
    rng = np.random.default_rng(5)
    key = np.unique(rng.integers(0, 1 << 62, 500).astype(np.uint64))
    context = rng.integers(0, 40, len(key)).astype(np.uint64)
    rows = (key, context, 7 * context.astype(np.int64), rng.integers(1, 9, len(key)), rng.random(len(key)).astype(np.float32))
    got = [suffix_tree.unpack_pairs(x) for _, x in suffix_tree.pack_pairs(*rows, 7)]
    assert len(got) == 7 and list(suffix_tree.pack_pairs(*(x[:0] for x in rows), 7)) == []
    once, twice = suffix_tree.merge_pairs(got), suffix_tree.merge_pairs(got + got[:3])
    assert all(np.array_equal(a, b) for a, b in zip(once, rows))
    again = np.isin(key, np.concatenate([g[0] for g in got[:3]]))
    assert np.array_equal(twice[3], rows[3] * np.where(again, 2, 1)) and np.array_equal(twice[1], context)


def test_suffix_tree_packets_are_small():
    """A pair takes little more room than its key, and frequent contexts are dealt over the parts."""
    rng = np.random.default_rng(7)
    context = np.sort(textscan.mix64(np.arange(8_000, dtype=np.uint64))[rng.zipf(1.3, 100_000) % 8_000])
    key = np.sort(rng.integers(0, 1 << 62, len(context)).astype(np.uint64))
    _, of, size = np.unique(context, return_inverse=True, return_counts=True)
    rows = (key, context, size[of], rng.zipf(2.5, len(key)) % 1000, np.ldexp(rng.zipf(1.5, len(key)) % 4000, -20).astype(np.float32))
    assert sum(len(x) for _, x in suffix_tree.pack_pairs(*rows, 50)) < 15 * len(key)
    packets = [(part, suffix_tree.unpack_pairs(x)) for part, x in suffix_tree.pack_pairs(*rows, 50, 500)]
    assert [part for part, _ in packets] == sorted({part for part, _ in packets}) and max(len(x[0]) for _, x in packets) < 5_000
    assert all(np.array_equal(a, b) for a, b in zip(suffix_tree.merge_pairs([x for _, x in packets]), rows))
    # the counts of all parts go back by the order of the packets
    _, order = suffix_tree.deal(key, context, size[of], 50, 500)
    assert np.array_equal(np.concatenate([x[0] for _, x in packets]), key[order])


def test_suffix_tree_lookup():
    keys, x = np.array([9, 3, 9, 5], np.uint64), np.array([5, 9, 4], np.uint64)
    assert suffix_tree.lookup(keys, x).tolist() == [3, 0, -1] and suffix_tree.lookup(keys[:0], x).tolist() == [-1] * 3


def test_suffix_tree_empty(hard_df):
    assert suffix_tree.score_documents(hard_df.limit(0)).count() == 0


def test_suffix_tree_grows_with_the_input(spark):
    """Ten times the topics: ten times the contexts and pairs, and each still scores its follower, however small its share of the text."""
    ensure_importable(spark)
    kept = {}
    for topics in (20, 200):
        rows = [(2 * k, " ".join(f"a{k} b{k} f{(7 * j + k) % 50}" for j in range(300))) for k in range(topics)]
        rows += [(2 * k + 1, f"a{k} b{k}") for k in range(topics)]
        docs, train = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), F.col("doc_id") % 2 == 0
        deep, flat = (suffix_tree.score(docs, train, p_min=0.5, depth=depth).filter("not train").toPandas().set_index("doc_id")["score"]
                      for depth in (3, 0))
        # b follows a in all of 300 sightings
        assert len(deep) == topics and (deep - flat > 0.5 * math.log10(topics)).all()
        ws = suffix_tree.Workspace(spark, "growth")
        blocks = ws.keep(suffix_tree.pack_blocks(docs.withColumn("train", train)), "blocks")
        _, told = suffix_tree.grow(blocks, ws.keep(suffix_tree.count_words(blocks), "counts"), ws, p_min=0.5)
        kept[topics] = {kind: len({x for d in told for r in d.filter(F.col("kind") == kind).collect()
                                   for x in np.frombuffer(r["keys"], dtype=np.uint64).tolist()}) for kind in ("states1", "pairs1")}
    assert all(kept[200][kind] > 8 * kept[20][kind] > 0 for kind in kept[200])


# -- 4 quality ---------------------------------------------------------------------------------------------

def test_quality_statistics_match_plain_counts(hard):
    texts = [r[1] for r in hard]
    got = []
    for size in (1 << 20,):
        for _, _, data, offs in textscan.text_slices(pa.array(texts, pa.string()), size):
            got.append(quality.statistics(data, offs))
    got = np.vstack(got)
    at = {f: k for k, f in enumerate(quality.FEATURES)}
    for row, t in zip(got, texts):
        w = H.WORD.findall(t or "")
        lower = H.words(t)
        assert close(row[at["log_words"]], math.log1p(len(w)))
        assert close(row[at["distinct_words"]] ** 2, len(set(lower)) / max(1, len(w)))
        assert close(row[at["top_word"]] ** 2, max(Counter(lower).values(), default=0) / max(1, len(w)))
        pairs = list(zip(lower, lower[1:]))
        assert close(row[at["repeated_pairs"]] ** 2, (len(pairs) - len(set(pairs))) / max(1, len(w)))
        assert close(row[at["lines"]] ** 2, (t or "").count("\n") / max(1, len(w)))


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert ((held.predicted == 1) == (held.quality == 1)).mean() > 0.93
    assert got.score.between(0, 1).all()


def test_quality_hard_cases(spark, hard_df):
    feats = hard_df.select("doc_id", F.lit(2).alias("fold"), quality.features(F.col("text")).alias("features"))
    none = spark.createDataFrame([], "doc_id long, quality int, score double")
    model = quality.fit(quality.labelled(feats, none, "quality"))
    assert {r[0] for r in feats.select(quality.score(F.col("features"), model)).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1, 0.0), (2, 0, 0.0), (2, None, 0.0), (3, 7, 0.0), (None, 1, 0.0), (99999, 1, 0.0)],
                                 "doc_id long, quality int, score double")
    model = quality.fit(quality.labelled(feats, some, "quality"))
    assert all(0 <= r[0] <= 1 for r in feats.select(quality.score(F.col("features"), model)).collect())
    assert feats.limit(0).select(quality.score(F.col("features"), model)).count() == 0


def test_isotonic_pooling():
    x, y = quality.pool_adjacent(np.arange(6.0), np.array([1.0, 0, 2, 1, 4, 4]), np.array([2.0, 2, 4, 4, 4, 4]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all() and abs(y[0] - 0.25) < 1e-12


# -- 7 byte-level BPE --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path(queries.VOCABULARY), "rb"))}
    return ranks, public.PATTERN, tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_two_vocabularies_in_one_session(spark, hard, tokenizer):
    """Vocabularies of one size keep apart, also in reused workers."""
    import public_tokenizers
    import tiktoken

    ranks, pattern, library = tokenizer
    other = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    assert len(other) == len(ranks) and bpe.vocabulary_key(other, pattern) != bpe.vocabulary_key(ranks, pattern)
    second = tiktoken.Encoding("second", pat_str=pattern, mergeable_ranks=other, special_tokens={})
    rows = [(i, t) for i, t, *_ in hard if t and len(t) < 3000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for table, plain in ((ranks, library), (other, second), (ranks, library)):
        got = Counter((r["doc_id"], tuple(r["ids"])) for r in bpe.encode(docs, table, pattern).collect())
        assert got == Counter((i, tuple(plain.encode_ordinary(t))) for i, t in rows)


def test_bpe_equals_the_library(tokenizer, hard, hard_df):
    ranks, pattern, library = tokenizer
    got = bpe.encode(hard_df, ranks, pattern).toPandas()
    expect = Counter()
    for i, t, *_ in hard:
        ids = library.encode_ordinary(t or "")
        expect[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids))] += 1
    have = Counter((None if i != i else int(i), n, a, b, tuple(ids)) for i, n, a, b, ids in got.itertuples(index=False))
    assert have == expect
    assert bpe.encode(hard_df.limit(0), ranks, pattern).count() == 0


def test_merge_replay_on_odd_words(tokenizer):
    ranks, pattern, library = tokenizer
    rng = np.random.default_rng(0)
    words = ["aaaaaaaaaa", "ab" * 50, "é" * 33, "<|endoftext|>", "  \n\n \t", "𝔘𝔫𝔦", "don't", "1234567890" * 9, "x" * 5000]
    words += ["".join(rng.choice(list("abcdefghij theén"), rng.integers(1, 40))) for _ in range(3000)]
    codec = bpe.Codec(ranks, pattern)
    raw = [w.encode() for w in words]
    assert codec.replay.encode_many(raw) == codec.replay.encode_few(raw)
    for w, ids in zip(words, codec.encode_batch(words)):
        assert ids == library.encode_ordinary(w)
        assert codec.replay.decode(ids) == w.encode()


def test_merge_order_when_a_merge_opens_a_lower_rank():
    """A table in which merging bc makes the lower-ranked abc possible in the same word."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"cd": 258, b"bcbc": 259}
    replay = bpe.MergeReplay(ranks, r".+")

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            found = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]

    words = [b"abcbc", b"bcbcabc", b"abcdabcd", b"bcabcbcbc", b"cdbc", b"aabcc"]
    assert replay.encode_few(words) == replay.encode_many(words) == [plain(w) for w in words]


# -- 8 n-gram join -----------------------------------------------------------------------------------------

def row_set(df):
    return Counter((None if a != a else int(a), int(b), None if c != c else int(c)) for a, b, c in df.itertuples(index=False))


def test_shingle_hashes_tell_orders_apart():
    """All shingles over a tiny vocabulary: no two of them, in any order of the words, share a hash."""
    from itertools import product
    grams = [" ".join(w) for size in (1, 2, 3, 4) for w in product("abcde", repeat=size)]
    seen = [int(g[0]) for _, _, data, offs in textscan.text_slices(pa.array(grams)) for g in ngram_join.shingle_sets(data, offs, 4)]
    assert len(set(seen)) == len(grams)


def test_ngram_join_equals_brute_force(hard, hard_df):
    got = ngram_join.near_duplicates(hard_df).select("doc_id", "n_shingles", "component_id").toPandas()
    assert row_set(got) == Counter(H.jaccard_components(hard))


class Stream:
    """Stands for a sorted, partitioned DataFrame: feeds batches of a few rows to a mapInArrow function."""

    def __init__(self, rows, step, cells=None):
        self.rows, self.step, self.cells = sorted(rows), step, cells

    def repartition(self, *columns):
        return self

    def sortWithinPartitions(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        def batches():
            for at in range(0, len(self.rows), self.step):
                part = list(zip(*self.rows[at:at + self.step]))
                cols = [pa.array(c, t) for c, t in zip(part, (pa.int64(), pa.int32(), pa.int64(), pa.bool_()))]
                names = ["gram", "n", "sig", "head"]
                if self.cells is not None:
                    cols.append(pa.array([self.cells] * len(cols[0]), pa.binary()))
                    names.append("cells")
                yield pa.RecordBatch.from_arrays(cols, names=names)
        return [tuple(r) for b in run(batches()) for r in zip(*(c.to_pylist() for c in b.columns))]


@pytest.mark.parametrize("step", [1, 2, 5, 1000])
def test_candidate_streams_lose_no_pair(step, monkeypatch):
    """Groups across batches, small and large: repeats go, lone postings go, admissible pairs stay connected."""
    rng = random.Random(step)
    for _ in range(40):
        monkeypatch.setattr(ngram_join, "GROUP_PAIRS", rng.choice([2, 3, 5]))
        n = {s: rng.randint(4, 12) for s in range(40)}
        rows = [(g, n[s], s, rng.random() < 0.7) for g in range(rng.randint(1, 25)) for s in rng.sample(range(40), rng.choice([1, 1, 2, 3, 4, 9]))]
        shared = ngram_join.shared_postings(Stream(rows + rng.sample(rows, len(rows) // 3), step))
        counts = Counter(r[0] for r in rows)
        assert sorted(shared) == sorted(r for r in rows if counts[r[0]] > 1)
        part = {s: s for s in n}

        def find(x):
            while part[x] != x:
                x = part[x]
            return x

        for a, b in ngram_join.candidates(Stream(shared, step, bytes([255] * ngram_join.SUMMARY)), 85):
            part[find(a)] = find(b)
        for k, x in enumerate(sorted(shared)):
            for y in sorted(shared)[k + 1:]:
                if x[0] == y[0] and x[3] and 100 * x[1] >= 85 * y[1]:
                    assert find(x[2]) == find(y[2])


def test_summary_bounds_the_intersection():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 62, 60_000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, k)) for k in (1, 5, 300, 3000, 30_000, 50_000)]
    rows = np.array([np.frombuffer(ngram_join.summary(s), dtype=np.uint8) for s in sets])
    for a in range(len(sets)):
        bound = ngram_join.shared_at_most(np.repeat(rows[a:a + 1], len(sets), axis=0), rows)
        assert all(x >= len(np.intersect1d(sets[a], s)) for x, s in zip(bound, sets))


def test_ngram_join_of_large_clusters(spark, monkeypatch):
    """Many near copies of one text in small chunks: all three rounds, stragglers included."""
    ensure_importable(spark)
    rng = np.random.default_rng(7)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.choice(120, rng.integers(1, 7), replace=False):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w), "en", "s"))
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 20)
    got = ngram_join.near_duplicates(H.documents(spark, rows)).select("doc_id", "n_shingles", "component_id").toPandas()
    assert row_set(got) == Counter(H.jaccard_components(rows))


def test_ngram_dedup_keeps_one_of_each(hard, hard_df):
    kept = ngram_join.deduplicate(hard_df).select("doc_id", "text").toPandas()
    parts = {}
    for (i, t, *_), (_, n, c) in zip(hard, H.jaccard_components(hard)):
        if i is not None and n and i == c:
            parts.setdefault((i, " ".join(H.words(t))), 0)
    have = Counter((int(i), " ".join(H.words(t))) for i, t in kept.itertuples(index=False) if i == i and H.words(t))
    assert have == Counter(parts.keys())
    assert ngram_join.deduplicate(hard_df.limit(0)).count() == 0


def test_ngram_join_of_rows_without_ids(spark):
    """A~B~C with B's id null are one component; of copies and near copies without any id one stays."""
    ensure_importable(spark)
    base = [f"w{k}" for k in range(100)]
    change = lambda words, *at: [f"x{k}" if k in at else w for k, w in enumerate(words)]
    a, b, c = change(base, 10, 11), base, change(base, 60, 61, 62, 63)
    other, near = [f"o{k}" for k in range(80)], change([f"o{k}" for k in range(80)], 40)
    rows = [(1, a), (None, b), (None, b), (2, c), (None, other), (None, other), (None, near), (3, ["lone", "words", "of", "a", "text"])]
    rows = [(i, " ".join(w), "en", "s") for i, w in rows] + [(None, "", "en", "s"), (None, None, "en", "s")]
    docs = H.documents(spark, rows)
    got = ngram_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").toPandas()
    assert {r[0]: r[2] for r in row_set(got) if r[0] is not None} == {1: 1, 2: 1, 3: 3}
    assert row_set(got) == Counter(H.jaccard_components(rows))
    kept = Counter((r["doc_id"], r["text"]) for r in ngram_join.deduplicate(docs).collect())
    unnamed = [t for i, t in kept.elements() if i is None]
    assert sorted(i for i, _ in kept if i is not None) == [1, 3]
    assert sum(t in (" ".join(other), " ".join(near)) for t in unnamed) == 1 and len(unnamed) == 3


# -- 10 language -------------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").toPandas()
    assert (got[got.held_out].lang_pred == got[got.held_out].lang).mean() > 0.97


def test_language_hard_cases(hard, hard_df):
    model = language.train(hard_df)
    got = language.predict(hard_df.select("doc_id", "text", "language"), model, into="__x").select("doc_id", "text", "__x.*").toPandas()
    for t, p, s in got[["text", "lang_pred", "score"]].itertuples(index=False):
        if any(c.isalpha() for c in t or ""):
            assert p in ("de", "en") and 0 < s <= 1
        else:
            assert p == "und" and s == 0
    nothing = language.train(hard_df.limit(0))
    assert {r[0] for r in language.predict(hard_df, nothing).select("language.lang_pred").collect()} == {"und"}
    assert language.predict(hard_df.limit(0), model).count() == 0


def plain_language(rows, learn):
    """(prediction, posterior) of every text with exact n-gram dictionaries instead of buckets."""
    def grams(t):
        s = "".join(c if c.isalpha() else " " for c in (t or "").lower())
        s = "".join(c for k, c in enumerate(s) if c != " " or (k and s[k - 1] != " "))
        return Counter(s[k:k + n] for n in (1, 2, 3) for k in range(len(s) - n + 1) if s[k:k + n].strip())

    counts, texts = {}, Counter()
    for (_, t, lang, *_), use in zip(rows, learn):
        if use and t is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(t))
            texts[lang] += 1
    buckets = language.BUCKETS
    out = []
    for _, t, *_ in rows:
        g = grams(t)
        if not g:
            out.append(("und", 0.0))
            continue
        total = {x: math.log(texts[x] / sum(texts.values()))
                 + sum(n * math.log((c[y] + language.SMOOTHING) / (sum(c.values()) + language.SMOOTHING * buckets)) for y, n in g.items())
                 for x, c in counts.items()}
        best = min(total, key=lambda x: (-total[x], x))
        out.append((best, 1 / sum(math.exp(v - total[best]) for v in total.values())))
    return out


def test_language_against_plain_bayes(spark, hard):
    """Equal up to n-grams that share a bucket: almost all predictions, and posteriors of clear ones."""
    rows = [(i, *r[1:]) for i, r in enumerate(x for x in hard if len(x[1] or "") < 5000)]
    learn = [i % 5 != 0 for i in range(len(rows))]
    want = plain_language(rows, learn)
    df = spark.createDataFrame([(r[0], r[1], r[2], k) for r, k in zip(rows, learn)], "doc_id long, text string, lang string, learn boolean").repartition(3)
    got = {r["doc_id"]: r["language"] for r in language.predict(df, language.train(df.filter("learn"))).collect()}
    same = [got[i]["lang_pred"] == w[0] for i, w in enumerate(want)]
    assert sum(same) >= len(same) - 1
    assert all(abs(got[i]["score"] - w[1]) < 0.02 for i, w in enumerate(want) if same[i] and w[1] > 0.999)


def test_language_slices_equal_one_matrix(spark, hard_df, monkeypatch):
    """Languages in slices of one and two, against all at once."""
    df = hard_df.withColumn("lang", F.when(F.col("lang").isNotNull(), F.concat("lang", (F.col("doc_id") % 3).cast("string"))))
    one = language.predict(df, language.train(df)).select("doc_id", "text", "language.*").toPandas()
    order = ["doc_id", "text", "lang_pred"]
    for size in (1, 2):
        monkeypatch.setattr(language, "MATRIX_BYTES", size * 4 * language.BUCKETS)
        model = language.train(df)
        assert model.slices > 1 and model.per_slice == size
        got = language.predict(df, model).select("doc_id", "text", "language.*").toPandas()
        a, b = (x.sort_values(order, na_position="first").reset_index(drop=True) for x in (one, got))
        assert a[order].equals(b[order]) and np.allclose(a["score"], b["score"])


def test_language_of_a_dirty_column(spark, monkeypatch):
    """More languages than a matrix holds: every text keeps a prediction."""
    ensure_importable(spark)
    monkeypatch.setattr(language, "MATRIX_BYTES", 1000 * 4 * language.BUCKETS)
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} word{'abcdefghij'[i % 10]}", f"x{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.train(df)
    assert model.slices == 3
    got = language.predict(df, model).select("doc_id", "language.*").collect()
    assert len(got) == 3000 and all(0 < r["score"] <= 1 and r["lang_pred"].startswith("x") for r in got)


def test_language_of_a_long_text_in_pieces(monkeypatch):
    text = "".join(random.Random(4).choice("abc  É12-ß\x00") for _ in range(5000))
    whole = [np.sort(b) for b, _ in language.ngrams([text], 1 << 14)]
    monkeypatch.setattr(language, "SLICE_CHARS", 7)
    parts = [[], [], []]
    for order, bucket in language.long_ngrams(text, 1 << 14):
        parts[order].append(bucket)
    assert all(np.array_equal(np.sort(np.concatenate(p)), w) for p, w in zip(parts, whole))


def test_language_ngrams_match_plain_ones():
    texts = ["Hello, World 12", "", "a", "ÄÖ ü\x00x", "  --  "]
    got = [Counter() for _ in texts]
    for bucket, row in language.ngrams(texts, 1 << 14):
        assert (np.diff(row) >= 0).all()
        for r in row.tolist():
            got[r]["n"] += 1
    def plain(t):
        s = "".join(c if c.isalpha() else " " for c in t.lower())
        out = "".join(c for k, c in enumerate(s) if c != " " or (k and s[k - 1] != " "))
        return sum(out[k:k + n].strip() != "" for n in (1, 2, 3) for k in range(len(out) - n + 1))
    assert [g["n"] for g in got] == [plain(t.replace("\x00", " ")) for t in texts]
