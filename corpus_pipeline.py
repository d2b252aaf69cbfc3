"""Corpus pipeline: quality rules, language ID, near-duplicate removal, mixing to target weights, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import langid, mixing, near_dedup, packing, quality
from quern.llm.queries import domains_of, language_model, table, tokenizer_path
from quern.llm.storage import materialize
from quern.session import ship

#: Least score of a kept document's main language.
LEAST_LANGUAGE_SCORE = 0.3
#: Low quality has left by the time of mixing.
MIX_TARGETS = {"clean": 0.96, "toxic": 0.04}


def whole_rows(docs: DataFrame) -> DataFrame:
    """The columns that stages read, and each row as it is in one more, so that no column of docs can clash with a stage's.
    The row stays in the JVM: Python workers get the text alone and give verdicts back."""
    return docs.select("doc_id", "text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are.

    Null, empty and short texts fail the base rules and go. Repeated rows and null ids are judged each by its text. Very
    long texts are counted whole. An empty table stays empty; further columns are carried, whatever their names."""
    ship(spark)
    verdicts = quality.quality_filter(whole_rows(docs), keep=("row",))
    return verdicts.where("kept").select("row.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language has a score of LEAST_LANGUAGE_SCORE at least, as they are.

    Null texts, and texts without a letter, are `und` and go; without a learned language all do. Repeated rows and null
    ids are judged each by its text. An empty table stays empty; further columns are carried, whatever their names."""
    ship(spark)
    out = langid.predict(whole_rows(docs), language_model(docs), keep=("row",))
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the least id, as it is.

    Rows are told apart by their id. Texts without words are alike to nothing and stay. Rows that share an id are one
    document: all of them stay or go. Rows with a null id can be named by no group and stay. An empty table stays empty;
    further columns are carried, whatever their names."""
    ship(spark)
    groups = near_dedup.near_duplicates(docs, shingle=5, percent=80)
    dropped = materialize(groups.where("not kept and doc_id is not null").select("doc_id").distinct())
    return docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its rate asks for, so that expected words by domain come to MIX_TARGETS.

    Sizes are counted in words between white space. Null and empty texts weigh nothing and follow the classifier's
    prior. Repeated rows draw alike; null ids draw like any other value. An empty table stays empty; further columns are
    carried, whatever their names."""
    mixed = mixing.mix(whole_rows(docs), domains_of(table(spark, sf_dir, "labels")), MIX_TARGETS, anchor="clean", free_anchor=True, carry=["row"])
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset (see packing.pack for nulls, repeats and long texts)."""
    ship(spark)
    return packing.pack(docs, tokenizer=tokenizer_path(), capacity=1024, end_id=2)


STAGES = [
    ("quality rules", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has neither the tokenizer nor the signatures; the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's result written as Parquet and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
