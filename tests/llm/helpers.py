"""Brute-force versions and hard-case tables for the operator tests."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: The columns of documents plus some whose names clash with what operators use inside.
DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, language string, "
              "size long, sig long, block long, features string, `range` long, key string, n int")


def doc_rows(rows):
    return [(i, t, lang, source, len(t or ""), 1.0, "x", 7, 8, 9, "f", 10, "k", 11) for i, t, lang, source in rows]


def documents(spark, rows):
    return spark.createDataFrame(doc_rows(rows), DOC_SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def hard_documents(seed=5, n=60):
    """(doc_id, text, lang, source): nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(seed)
    en = "the of and to in that was for with this from have not are but".split()
    de = "der die und das nicht ist ein mit auch sich für über schön groß".split()
    rows = []
    for i in range(n):
        lang, pool = ("en", en) if i % 3 else ("de", de)
        text = " ".join(rng.choice(pool) + rng.choice(["", "", ",", "."]) for _ in range(rng.randint(1, 80)))
        rows.append((i, text, lang, f"s{i % 4}" if i % 5 else None))
    base = " ".join(rng.choice(en) + str(rng.randint(0, 99)) for _ in range(200))
    change = lambda k: " ".join(w if j != k else "changed" for j, w in enumerate(base.split()))
    rows += [(100 + k, change(20 * k + 3), "en", "s0") for k in range(6)]            # near copies
    rows += [(120 + k, base, "en", "s0") for k in range(4)]                          # exact copies
    rows += [rows[3], rows[3], (4, "another text of the same id altogether", "en", "s1")]
    rows += [(200, None, "en", "s1"), (201, "", "de", None), (202, " \n\t ", None, "s1"), (203, "one", None, None),
             (204, "1234 5678 !!", "en", "s2"), (205, "One two THREE", "en", "s2"), (206, "one two three", "en", "s2")]
    rows += [(300, "lang words " * 30_000, "en", "s3"), (301, "x" * 200_000, "en", "s3"), (None, base, "en", "s0"), (None, None, None, None)]
    return rows


def jaccard_components(rows, size=4, percent=85):
    """Per row (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for _, t, *_ in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    label = list(range(len(rows)))
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                changed = True
    ids = {}
    for r, k in zip(rows, label):
        if r[0] is not None:
            ids[k] = min(ids.get(k, r[0]), r[0])
    return [(r[0], len(s), ids.get(k, r[0]) if s else r[0]) for r, s, k in zip(rows, sets, label)]


def base_scores(rows):
    """doc_id -> set of (n_tokens, n_known, N, base score) by counting."""
    counts = Counter()
    tokens = [words(t) + [None] for _, t, *_ in rows]
    for (i, *_), w in zip(rows, tokens):
        if fold(i, 10):
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [(i, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for (i, *_), w in zip(rows, tokens)]
