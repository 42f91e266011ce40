"""Order MinHash against a plain version of its definition, and the edits it compares."""

from __future__ import annotations

import hashlib
import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import helpers as H  # noqa: E402

from touchcredit.llm import order_minhash as O  # noqa: E402

SPLIT = re.compile(r"[฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003FFFF]"
                   r"|[^\x20\x09-\x0D฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003FFFF]+")
MASK, PLACE = (1 << 33) - 1, 30


def hashes(spark, tuples):
    """xxhash64 of tuples of one shape, by Spark itself: the hash function is not what is tested here."""
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(tuples)])
    return [r[0] for r in rows.select(F.xxhash64(*rows.columns[1:]).alias("h"), "_1").orderBy("_1").select("h").collect()]


def expected(spark, text, k, size, m):
    """Every signature by sorting all numbered k-mers along its rotation of the circle."""
    words = SPLIT.findall(text)
    grams = [tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    if not grams:
        return []
    ids = [h & MASK for h in hashes(spark, grams)]
    seen, numbered = {}, []
    for x in ids:
        numbered.append((x, seen.get(x, 0)))
        seen[x] = seen.get(x, 0) + 1
    schema = "i int, h long, o int"
    df = spark.createDataFrame([(i, h, o) for i, (h, o) in enumerate(numbered)], schema)
    ranks = [r[0] & MASK for r in df.orderBy("i").select(F.xxhash64("h", "o")).collect()]
    out = []
    for j in range(m):
        start = j * ((1 << 33) // m)
        first = sorted(range(len(ranks)), key=lambda i: ((ranks[i] - start) % (1 << 33), i))[:size]
        out.append([ranks[i] for i in sorted(first)])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(out)], "i int, x array<long>")
    return [r[0] for r in df.orderBy("i").select(F.xxhash64("x")).collect()]


def brute_edits(rows):
    """(doc_id, n_chars, digest of the edited text) from one sorted list."""
    def key(r):
        return (r[0] is None, -(r[0] or 0))
    order = sorted(rows, key=key)
    out = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        cut = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("k,size,m", [(2, 2, 8), (1, 3, 4), (3, 1, 16)])
def test_signatures_against_definition(spark, k, size, m):
    texts = ["", " \n", "one", "a b", "b a", "a a a a a b a a a", "the cat sat on the mat and the cat sat on the hat",
             "漢字かな交じり文 and words", "ภาษาไทย", " ".join(f"w{i * i % 31}" for i in range(200))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r["i"]: r["s"] for r in O.signatures(df, F.col("text"), "s", k, size, m).collect()}
    for i, t in enumerate(texts):
        assert got[i] == expected(spark, t, k, size, m), t


def test_sensitive_to_order_and_edits(spark):
    base = [f"w{i}" for i in range(400)]
    turned = [w for b in range(0, 400, 20) for w in reversed(base[b:b + 20])]
    texts = [" ".join(base), " ".join(base[:200] + base[300:] + base[200:300]), " ".join(turned), " ".join(base[:390] + ["x"] * 10), "other words"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    first = {}
    for k in (1, 2):
        rows = {r["i"]: r["s"] for r in O.signatures(df, F.col("text"), "s", k, 2, 256).collect()}
        first[k] = [sum(a == b for a, b in zip(rows[0], rows[i])) / 256 for i in range(5) if rows[i]]
    same, moved, reversed_, tail, other = first[1]
    # equal sets of words: only the order tells them apart
    assert same == 1 and 0.5 < moved < 0.95 and reversed_ < 1 and other == 0
    assert first[2][3] > 0.85 and first[2][2] == 0


def test_edits_against_brute_force(spark):
    rows = [(r[0], r[1] or "") for r in H.hard_documents(n=25) if r[0] not in (3, 4, 300, 301)]
    rows = list({r[0]: r for r in rows}.values()) + [(-5, "négatif é"), (1 << 62, "große Zahl " * 40), (-(1 << 63), "least")]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, own int, chunk int, key int").repartition(3)
    for ranges in (1, 5, 200):
        got = O.fingerprint_edits(df, ranges=ranges).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in got) == sorted(
            (i is None, i or 0, n, h) for i, n, h in brute_edits(rows))
    prints = {r["doc_id"]: r for r in got}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (i, t), (j, _) in zip(order, order[1:] + order[:1]):
        a, b = prints[i]["fingerprint"], prints[j]["fingerprint"]
        cells = lambda s: [s[x:x + 8] for x in range(0, len(s), 8)]
        want = sum(x == y for x, y in zip(cells(a), cells(b))) / O.M if a or b else 1.0
        assert abs(prints[i]["near_next"] - want) < 1e-9 and 0 <= prints[i]["near_edited"] <= 1
        assert len(a) == (8 * O.M if t.split() else 0)
    same = {t: set() for _, t in rows}
    for i, t in rows:
        same[t].add(prints[i]["fingerprint"])
    assert all(len(x) == 1 for x in same.values())


def test_hard_rows(spark):
    docs = H.documents(spark, H.hard_documents())
    got = O.fingerprint_edits(docs, ranges=7).toPandas()
    assert len(got) == docs.count() and got["near_edited"].between(0, 1).all() and got["near_next"].between(0, 1).all()
    assert O.fingerprint_edits(docs.limit(0)).count() == 0
    one = O.fingerprint_edits(spark.createDataFrame([(7, "abc def ghi")], "doc_id long, text string")).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"abc def abc").hexdigest() and one[0]["near_next"] == 1.0
    null = O.fingerprint_edits(spark.createDataFrame([(None, None), (None, "x")], "doc_id long, text string")).collect()
    assert sorted((r["n_chars"], r["fingerprint"] == "") for r in null) == [(0, True), (1, False)]


def test_native(spark):
    plan = O.fingerprint_edits(H.documents(spark, H.hard_documents()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    # the text moves once, for its neighbour
    assert plan.count("Exchange hashpartitioning") == 1
