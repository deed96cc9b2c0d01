"""A training-data pipeline over ``documents``: five stages, each one operator of ``threadline.llm``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of ``documents``; the last one returns the packed pieces.  A null
text is an empty text in every stage; rows with a null id are kept apart from
rows with ids; identical rows are one document from the second stage on; other columns
pass through unchanged; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadline.llm import decontaminate, exact_dedup, jaccard_join, packing, quality_knn
from threadline.llm.common import checkpointed, documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote accepts."""
    return quality_knn.keep_accepted(docs, quality_knn.fit(docs, documents(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard_join.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean_rows(docs, documents(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with bin, offset and capacity."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: The classifier has no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
