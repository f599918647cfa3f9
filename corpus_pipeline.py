"""From raw documents to packed sequences; counted with ``playpulse.llm``.

Five stages, each over all that the one before it kept: quality rules drop documents, one
document of each group of near duplicates stays, secrets are masked in the texts, sources are
mixed to their target shares (rows in that order), and the texts are packed into sequences
that follow the mix; ``sequence_position`` is the order to read them in.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playpulse.config import scratch_path
from playpulse.llm.common import temporary
from playpulse.llm.mixing import RECIPE, in_mix_order
from playpulse.llm.ngram_join import one_of_each_group
from playpulse.llm.packing import pack_documents
from playpulse.llm.quality_rules import kept_documents
from playpulse.llm.queries import TOKENIZER, table
from playpulse.llm.secret_scan import redacted
from playpulse.sources.files import delete


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep (operator 7), with cutoffs from the labelled ones."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 8)."""
    return one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked (operator 9)."""
    return redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix (operator 3)."""
    return in_mix_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens (operator 6), filled and numbered in the order of the mix."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), weights=RECIPE)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources", mixed),
    ("packing", packed),
]
#: The last stage needs a tokenizer, which SQL doesn't have; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages after one another over ``documents``; each is written and read again.

    What a stage staged for itself is deleted once its rows are written, and these once the
    next stage's are, so no text, masked or not, is left behind, also after an error. The last
    stage has read its texts when it returns; its rows come from pieces without text.
    """
    docs, texts = table(spark, sf_dir, "documents"), []
    try:
        for name, stage in STAGES[:-1]:
            with temporary(spark):
                rows = stage(spark, docs, sf_dir)
                texts.append(scratch_path(spark, f"llm-{name.replace(' ', '-')}"))
                rows.write.parquet(texts[-1])
            docs = spark.read.schema(rows.schema).parquet(texts[-1])
            for path in texts[:-1]:
                delete(spark, path)
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        for path in texts:
            delete(spark, path)
