"""The bitmap of wanted ids: no wanted id is lost, and it filters before it is full."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchcredit.llm import ngram_join
from touchcredit.llm.common import ensure_importable


def test_bitmap_keeps_what_is_wanted(spark, monkeypatch):
    ensure_importable(spark)
    ids = spark.range(-500, 3000, 7, 3).select(F.col("id").alias("least"))
    docs = spark.range(-2000, 9000).select(F.col("id").alias("doc_id"))
    wanted = {r[0] for r in ids.collect()}
    for bits, piece in ((26, 16), (14, 8), (5, 3)):
        monkeypatch.setattr(ngram_join, "ID_BITS", bits)
        monkeypatch.setattr(ngram_join, "ID_PIECE_BITS", piece)
        bitmap = ngram_join.id_bits(ids)
        assert len(bitmap) == 1 << (bits - 3)
        kept = {r[0] for r in docs.filter(ngram_join.may_hold(bitmap, F.col("doc_id"), spark)).collect()}
        assert wanted <= kept and (len(kept) == len(wanted) or bits < 26)
    assert not ngram_join.id_bits(ids.limit(0)).any()
