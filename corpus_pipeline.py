"""A corpus pipeline over ``documents``: each stage is one operator of ``tidemark.llm``.

SQL can't express the near-copy join and the byte-pair encoding; the stages are tested against brute force instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_pair, mixing, near_copies, personal_data, quality_rules
from tidemark.llm.common import table, written

STAGES = [
    ("quality rules", quality_rules.stage),
    ("near copies", near_copies.stage),
    ("personal data", personal_data.stage),
    ("mixing", mixing.stage),
    ("byte-pair encoding", byte_pair.stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else written(docs), sf_dir)
    return docs
