"""The classifier's fit and the whole pipeline against plain versions."""

from __future__ import annotations

import base64
import hashlib
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parent))
import helpers as H  # noqa: E402
from test_llm_text import plain_language  # noqa: E402

import corpus_pipeline  # noqa: E402
from touchcredit.llm import common, mixing, quality, queries, stages  # noqa: E402
from touchcredit.llm.common import ensure_importable  # noqa: E402

SF = "/root/testdata/sf0.001"


def isotonic(y, n):
    """Least squares under order, by the min-max formula."""
    out = []
    for i in range(len(y)):
        best = -math.inf
        for j in range(i + 1):
            best = max(best, min(y[j:k + 1].sum() / n[j:k + 1].sum() for k in range(i, len(y))))
        out.append(best)
    return np.array(out)


def plain_scores(x, label, calibrate, w, b):
    """Scores of all rows of ``x`` (features) from those with a label (NaN: none), by one least-squares solve."""
    known = ~np.isnan(label)
    fit, cal = known & ~calibrate, known & calibrate
    mean, std = x[fit].mean(axis=0), np.sqrt(np.maximum(x[fit].var(axis=0), 1e-12)) + 1e-3
    z = np.clip((x - mean) / std, -6, 6)
    phi = np.column_stack([math.sqrt(2 / quality.COSINES) * np.cos(z @ w + b), np.ones(len(x))])
    penalty = np.sqrt(np.append(np.full(quality.COSINES, quality.RIDGE), 1e-6))
    beta, *_ = np.linalg.lstsq(np.vstack([phi[fit], np.diag(penalty)]), np.append(label[fit], np.zeros(len(penalty))), rcond=None)
    raw = phi @ beta
    use = cal if cal.any() else fit
    at = np.clip((raw[use] + 1) / 3 * quality.BINS, 0, quality.BINS - 1).astype(int)
    bins, place = np.unique(at, return_inverse=True)
    y, n = np.bincount(place, weights=label[use]), np.bincount(place).astype(float)
    level = isotonic(y, n)
    centres, values = [], []
    for v in np.unique(level):
        same = level == v
        centres.append((((bins[same] + 0.5) / quality.BINS * 3 - 1) * n[same]).sum() / n[same].sum())
        values.append(v)
    return 0.99 * np.interp(raw, centres, values) + 0.01 / (1 + np.exp(-4 * (raw - 0.5)))


def test_quality_fit_against_plain_least_squares(spark):
    ensure_importable(spark)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    label = (x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.3 * rng.normal(size=400) > 0.4).astype(float)
    for calibrate in (np.arange(400) % 4 == 0, np.zeros(400, bool)):
        df = spark.createDataFrame([(list(map(float, r)), float(v), bool(c)) for r, v, c in zip(x, label, calibrate)],
                                   "features array<double>, label double, calibrate boolean").repartition(5)
        model = quality.fit(df)
        want = plain_scores(x, label, calibrate, model["w"], model["b"])
        assert np.allclose(quality.probability(x, model), want, atol=1e-6)


def features(texts):
    return np.vstack([quality.statistics(data, offs) for _, _, data, offs in quality.text_slices(pa.array(texts, pa.string()))])


def plain_pipeline(docs, labels):
    """Counter of (doc_id, n_tokens, digest of the ids) from rows (doc_id, text, lang, source)."""
    # quality
    x = features([t for _, t, *_ in docs])
    fold = np.array([H.fold(i, 5) for i, *_ in docs])
    label = np.array([labels.get(i, math.nan) if f else math.nan for (i, *_), f in zip(docs, fold)])
    rng = np.random.default_rng(quality.SEED)
    d = len(quality.FEATURES)
    w, b = rng.normal(size=(d, quality.COSINES)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, quality.COSINES)
    score = plain_scores(x, label, fold == 1, w, b)
    docs = [r for r, s in zip(docs, score) if s >= stages.LEAST_QUALITY]
    # language
    said = plain_language(docs, [H.fold(i, 5) != 0 for i, *_ in docs])
    docs = [r for r, (lang, p) in zip(docs, said) if lang != "und" and p >= stages.LEAST_LANGUAGE]
    # near duplicates
    docs = [r for r, (i, n, c) in zip(docs, H.jaccard_components(docs, 5, 80)) if n == 0 or i == c]
    # mix
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in docs], "text": [r[1] for r in docs], "source": [r[3] for r in docs]}))
    taken = {r[0]: (r[1], r[2]) for r in con.sql(f"SELECT doc_id, size, taken FROM ({queries.OP1_SQL})").fetchall()}
    times = {i: math.floor(t / n + 0.5) if n else 0 for i, (n, t) in taken.items()}
    # tokens
    ranks = {base64.b64decode(a): int(r) for a, r in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = Counter()
    for i, t, *_ in docs:
        ids = library.encode_ordinary(t or "")
        out[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())] += times[i]
    return +out


def test_whole_pipeline_against_plain_stages(spark):
    con = duckdb.connect()
    docs = con.sql(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()
    labels = dict(con.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect())
    want = plain_pipeline(docs, labels)
    assert len(want) > 100 and len({i for i, *_ in want}) < len(docs)
    assert got == want


def test_run_leaves_only_its_own_tables(spark):
    """The tables of the stages are dropped once their result is written."""
    before = set(common.workspaces())
    corpus_pipeline.run(spark, SF)
    left = set(common.workspaces()) - before
    assert len(left) == 1 and "/pipeline-" in left.pop()


def test_mix_moves_no_texts(spark):
    """Only documents that differ from their source's usual number of times meet the texts in a join."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    limits = {"spark.sql.autoBroadcastJoinThreshold": "8k", "spark.sql.adaptive.autoBroadcastJoinThreshold": "8k"}
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        mixed = stages.mix(spark, docs, "")
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "Exchange hashpartitioning" not in plan
        got = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
        taken = mixing.mix(docs).filter("size > 0").selectExpr("doc_id", "CAST(round(taken / size) AS INT) AS times")
        want = Counter()
        for r in taken.collect():
            want[r["doc_id"]] += r["times"]
        assert got == +want and len(set(want.values())) > 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
