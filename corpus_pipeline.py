"""Corpus pipeline: five stages over ``documents``, each written and reread.

Quality classifier, n-gram Jaccard join, secret scans, mixing, byte-level BPE.
Null columns, empty texts and repeated rows pass as the operators state it; an
empty table gives an empty result at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthledger.llm.bpe import bpe_stage
from monthledger.llm.common import materialize, table
from monthledger.llm.jaccard import jaccard_stage
from monthledger.llm.mixing import mix_stage
from monthledger.llm.quality import quality_stage
from monthledger.llm.secrets import secrets_stage

STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("secret_scans", secrets_stage),
    ("mixing", mix_stage),
    ("byte_bpe", bpe_stage),
]
#: The classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
