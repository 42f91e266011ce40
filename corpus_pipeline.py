"""Corpus pipeline: quality, language, near-duplicates, mixing, token encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes and rereads as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchcredit.llm.common import Workspace, drop_workspaces, table, workspaces
from touchcredit.llm.stages import STAGES

#: The quality classifier is fitted, which SQL cannot express; see tests/llm for the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. The tables that a stage wrote for itself are dropped once its result is written."""
    ws = Workspace(spark, "pipeline")
    docs, others = table(spark, sf_dir, "documents"), workspaces()
    for i, (name, stage) in enumerate(STAGES):
        docs = ws.keep(stage(spark, docs, sf_dir), f"{i}-{name}")
        drop_workspaces(keep=others)
    return docs
