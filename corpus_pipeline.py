"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of documents, of the rows that they keep and as they were.

Defined results, for every stage: an empty table gives no rows; a null text
counts as an empty one and stays null; rows are judged by their whole text, so
very long texts are neither cut nor skipped; repeated rows are judged alike;
other columns, whatever their names, are kept and never enter a decision; null
values in them stay. A stage's side table (labels, benchmark) may be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crossview.llm import decontaminate, jaccard_join, packing, quality_classifier, toxicity
from crossview.llm.common import drop_path, fresh_path, stash, table
from crossview.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3 (a score of just 0.3 goes).

    Without labels of both classes every text scores the share of toxic labels, 0.0001 without any, so all stay.
    A null doc_id changes nothing, as ids enter no score; an id labelled twice takes its largest label.
    """
    ship_package(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more (a score of just 0.3 stays).

    Without positive labels every text scores 0.5, so all stay. The unlabelled side is this stage's own input.
    """
    ship_package(spark)
    return quality_classifier.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Texts without words are like no other, so each of their ids stays. Of repeated rows one stays. Of several texts
    under that id one stays, and rows without an id all do.
    """
    ship_package(spark)
    return jaccard_join.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are words of benchmark passages (just a twentieth goes).

    Texts without words stay. Items without words, or an empty benchmark, hit nothing.
    """
    ship_package(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens.

    Every row is one document, also if its id is null or occurs twice; an empty text is its end token alone.
    """
    ship_package(spark)
    return packing.query(spark, sf_dir, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("near-duplicate join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, one after the other; what a stage keeps is in the shared folder until the next one has read it."""
    docs, last = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = fresh_path(spark, name.replace(" ", "-"))
            docs = stash(docs, name.replace(" ", "-"), path)
            if last:
                drop_path(spark, last)
            last = path
    return docs


#: Trained models and packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None
