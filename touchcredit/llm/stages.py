"""Stages of the corpus pipeline, one per operator: ``(spark, docs, sf_dir) -> DataFrame``.

Each works on all rows it is given. All but the last return the columns of
``docs`` as they came; helper columns get names that ``docs`` does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm import bpe, language, mixing, ngram_join, quality
from touchcredit.llm.common import Workspace, ensure_importable, fold, free_name, table

#: Documents below these scores go.
LEAST_QUALITY = 0.3
LEAST_LANGUAGE = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    ws = Workspace(spark, "stage-quality")
    feats = ws.keep(docs.select("doc_id", fold("doc_id", 5).cast("int").alias("fold"), quality.features(F.col("text")).alias("features")),
                    "features")
    model = quality.fit(quality.labelled(feats, table(spark, sf_dir, "labels"), "quality"))
    name = free_name(docs, "score")
    return (docs.withColumn(name, quality.score(quality.features(F.col("text")), model))
            .filter(F.col(name) >= LEAST_QUALITY).select(*columns(docs)))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified: not ``und``, and more likely than all others together."""
    ensure_importable(spark)
    model = language.train(docs.filter(fold("doc_id", 5) != 0))
    name = free_name(docs, "language")
    return (language.predict(docs, model, into=name)
            .filter((F.col(f"{name}.lang_pred") != "und") & (F.col(f"{name}.score") >= LEAST_LANGUAGE)).select(*columns(docs)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate group: five-word shingles, Jaccard 0.8."""
    ensure_importable(spark)
    return ngram_join.deduplicate(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, to the nearest whole time: 0 to 3."""
    ws = Workspace(spark, "stage-mix")
    taken = mixing.mix(docs)
    # rows equal in id, source and size are interchangeable: they share what they are taken together
    key = mixing.shuffle_key("of_doc")
    times = ws.keep(taken.filter("size > 0").groupBy("doc_id", "source", "size").agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("times"))
        .select(F.col("doc_id").alias("of_doc"), F.col("source").alias("of_source"), F.col("size").alias("of_size"), "times")
        .withColumn("of_key", key), "times")
    # A source is taken whole some times and once more up to a place in its stream: a row per source says where, and
    # only documents that differ from it meet the texts in a join, so the texts stay where they are.
    cuts = times.groupBy(F.col("of_source").alias("cut_source")).agg(
        F.max("times").alias("most"), F.min("times").alias("least"), F.max(F.struct("times", "of_key"))["of_key"].alias("cut"))
    cuts = ws.keep(cuts, "cuts")
    usual = lambda k: F.when(k <= F.col("c.cut"), F.col("c.most")).otherwise(F.col("c.least"))
    others = ws.keep(times.join(cuts.alias("c"), F.col("of_source").eqNullSafe(F.col("cut_source"))).filter(F.col("times") != usual(F.col("of_key")))
                     .select("of_doc", "of_source", "of_size", "times"), "others")
    kept = columns(docs)
    rows = docs.withColumn(size := free_name(docs, "size"), mixing.word_count("text")).alias("d").filter(F.col(size) > 0)
    joined = rows.join(cuts.alias("c"), F.col("d.source").eqNullSafe(F.col("c.cut_source")))
    many = usual(mixing.shuffle_key("d.doc_id"))
    if not others.isEmpty():
        joined = joined.join(others.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.of_doc")) & F.col("d.source").eqNullSafe(F.col("t.of_source"))
                             & (F.col(f"d.{size}") == F.col("t.of_size")), "left")
        many = F.coalesce(F.col("t.times"), many)
    return (joined.withColumn(n := free_name(docs, "times"), many).filter(F.col(n) > 0)
            .select(*[F.col(f"d.{c}") for c in kept], F.explode(F.sequence(F.lit(1), F.col(n))).alias(free_name(docs, "copy")))
            .select(*kept))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of their decoding."""
    import public_tokenizers

    ensure_importable(spark)
    # the executors still hold the heap of the stages before
    return bpe.encode(docs, bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, batch_chars=1 << 20)


def columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mix),
    ("byte-level BPE", encode),
]
