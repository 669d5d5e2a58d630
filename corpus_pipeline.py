"""A training-corpus pipeline over ``documents``: five stages, each by one text operator.

1. toxicity: documents scored as toxic (0.7 or more) go.
2. near duplicates: one document, that of the least doc_id, stays of each
   group linked by five-word shingles with a Jaccard similarity of 0.8 or more.
3. repeats: bytes covered by a 50-byte string that also starts in a document
   with a smaller doc_id are cut out of the text; all documents stay.
4. decontamination: documents with a ten-word window of a benchmark item go.
5. packing: what is left is tokenised and packed into sequences of 2048.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept,
and all but the last return the columns of ``documents``.

Defined cases: null or empty texts pass every filter (they match nothing) and
are packed as the end id alone; rows without a doc_id pass the second stage,
as no group can name them; rows that share a doc_id are documents of their own
there, and of a group's rows of the least doc_id that of the least text stays;
extra columns are carried along; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import fresh, stored, table
from tidewater.llm.decontaminate import decontaminate
from tidewater.llm.jaccard import similarity_classes
from tidewater.llm.langid import held_out
from tidewater.llm.packing import pack
from tidewater.llm.substring_dedup import remove_repeats
from tidewater.llm.tokens import public_file
from tidewater.llm.toxicity import THRESHOLD, learn_from_tables, score

SHINGLE_WORDS, SIMILARITY = 5, (80, 100)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = learn_from_tables(docs, table(spark, sf_dir, "labels"), held_out(3, 1))
    into = fresh(docs.columns, "toxicity_score")
    return score(docs, model, into=into).where(F.col(into) < THRESHOLD).drop(into)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.where("doc_id is not null")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        classes = similarity_classes(named, SHINGLE_WORDS, *SIMILARITY)
        id_ = fresh(docs.columns, "kept_id")
        kept = classes.where("doc_id = component_id").select(F.col("doc_id").alias(id_))
        kept = named.join(kept, named["doc_id"] == kept[id_], "left_semi")
    else:
        kept = _one_row_of_each_group(named)
    return kept.unionByName(docs.where("doc_id is null"))


def _one_row_of_each_group(named: DataFrame) -> DataFrame:
    """The same where a doc_id may have several rows: rows get numbers, and the numbers are grouped."""
    row = fresh(named.columns, "row_no")
    rows = stored(named.withColumn(row, F.monotonically_increasing_id()), "rows")
    texts = rows.select(row, F.col("doc_id").alias("named"), "text")
    classes = similarity_classes(texts.select(F.col(row).alias("doc_id"), "text"), SHINGLE_WORDS, *SIMILARITY)
    group = classes.select(F.col("doc_id").alias(row), "component_id")
    least = texts.join(group, row).groupBy("component_id").agg(F.min(F.struct("named", "text", row)).alias("one"))
    return rows.join(least.select(F.col("one")[row].alias(row)), row, "left_semi").drop(row)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("suffix_array_dedup", cut_repeats),
    ("decontaminate", without_benchmarks),
    ("best_fit_packing", packed),
]

#: None: SQL expresses neither a trained score nor the packing; tests compare with brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
