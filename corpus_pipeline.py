"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next one's documents. The settings are those of
production: near copies are texts that share five-word shingles with a Jaccard
likeness of 0.8 or more. Stages read whole texts, however long; columns that are
added to ``documents`` pass through under their names, whatever these are, and
an empty table gives an empty one. The session keeps small Arrow batches from the
first stage on, as whoever writes a stage's result runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aquilith.llm.common import Workspace, bound_batches
from aquilith.llm.language import keep_identified, train
from aquilith.llm.mixing import mixed
from aquilith.llm.partenum import one_of_each
from aquilith.llm.pieces import encode_docs
from aquilith.llm.templates import drop_lines


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier tells.

    Texts that are null, empty or without a letter go, and those whose best
    language is less than 0.025 of raw score ahead of the next (so ties go).
    Rows with a null id, label or source are judged like others; rows repeated
    stay or go together.
    """
    bound_batches(spark)
    return keep_identified(docs, train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; none is dropped as a whole.

    Templates that keep 8 or more tokens without a digit recur from the second
    different text on, shorter ones from the fifth. The document of the least
    id keeps them, nulls last; rows repeated are treated alike. A null text stays
    null, one that loses all lines is empty.
    """
    bound_batches(spark)
    return drop_lines(docs, long_tokens=8)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the least id.

    Of rows repeated with id and text one stays. Texts that are null or without
    words, and rows with a null id, stay.
    """
    bound_batches(spark)
    return one_of_each(docs, shingle=5, threshold=80)


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, copies behind each other.

    A null source is one like others, a null text has no words; of rows repeated
    any number may take one copy more than the others.
    """
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with merge-dropout drawn for each copy.

    A null or empty text has no tokens. Rows repeated behind each other, as the
    mix writes copies, are cut differently, others alike.
    """
    bound_batches(spark)
    return encode_docs(docs, number_runs=True)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_copies),
    ("mixing", weights),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; what is read no more is deleted."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work.put(stage(spark, docs, sf_dir))
        work.only(docs)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language, merge-dropout and the samples' digests are not expressible in SQL.
ORACLE_SQL = None
