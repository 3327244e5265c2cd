"""The documents, made into training data in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as
the next one's docs. All but the last keep the columns of the documents. A row, text or source
that is null or empty, repeated rows, and an empty table are treated as the stage's operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import bpe, jaccard, mixing, substrings, toxicity
from tributary.llm.common import held_out
from tributary.llm.queries import VOCABULARY
from tributary.storage import write_and_read

#: The toxicity chain and the curves cannot be written in SQL; the stages are tested one by one instead.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained chain scores below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, skip=held_out("doc_id", 4, 2))
    return toxicity.score(docs, model, keep=docs.columns).filter("_toxic_predicted = 0").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of passages that occur elsewhere, too."""
    return substrings.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with their number and digests."""
    return bpe.encode(docs, VOCABULARY, keep_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("mixing", mixed),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = write_and_read(out, f"corpus-{name}") if name != STAGES[-1][0] else out
    return docs
