"""Clean-up of a corpus: STAGES run one after the other, each over what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tijara.llm.bpe_codec import stage_bpe
from tijara.llm.common import read_documents, stored
from tijara.llm.decontaminate import stage_decontaminate
from tijara.llm.exact_dedup import stage_exact_dedup
from tijara.llm.jaccard_join import stage_near_dedup
from tijara.llm.quality_knn import stage_quality

STAGES = [
    ("quality", stage_quality),
    ("exact_dedup", stage_exact_dedup),
    ("near_dedup", stage_near_dedup),
    ("decontaminate", stage_decontaminate),
    ("bpe", stage_bpe),
]

# the classifier is trained, the similarity join iterates and the encoder reads vocabulary files:
# no SQL gives these rows, so tests/llm holds the stages against brute-force versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents`` under ``sf_dir``."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
