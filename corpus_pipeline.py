"""From raw documents to packed training sequences: five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again as the
next stage's documents. All but the last return the columns they got. Columns that an operator would
replace travel inside a struct, so any extra column passes through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscore.llm import language_id, line_dedup, mixing, near_dedup, packing
from tellerscore.llm.common import documents
from tellerscore.llm.queries import DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, domain_of
from tellerscore.session import new_path, scratch_scope

#: Least posterior of the predicted language.
LEAST_SCORE = 0.5
#: Part of the remaining tokens that the mixture takes, each document at most once.
MIX_SHARE, MIX_EPOCHS = (3, 4), 1
CAPACITY = 2048
#: No SQL can express the language model, near duplicates or tokens.
ORACLE_SQL = None


def _wrapped(docs: DataFrame, *names: str) -> DataFrame:
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), *[docs[c] for c in names])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; null text, text without letters and unclear text go."""
    model = language_id.fit(docs)
    found = language_id.predict(_wrapped(docs, "text"), model)
    clear = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(clear).select("_doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that three or more share; ``n_chars`` follows where lines went.

    A null text counts as one empty line and comes out empty. Of the documents that share a line the largest id keeps
    it, a null id being the smallest; rows that repeat an id count as one document. Any other column passes through.
    """
    found = line_dedup.dedupe_lines(
        docs.select(F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("_doc"), "doc_id", "text")
    )
    columns = {c: F.col("text") if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns}
    if "n_chars" in columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("n_dropped") > 0, length).otherwise(columns["n_chars"])
    return found.select(*[value.alias(name) for name, value in columns.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    found = near_dedup.near_duplicates(docs.select("doc_id", "text", mark.alias("_mark")))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_gone")).distinct()
    marked = docs.withColumn("_mark", mark)
    kept = marked.join(
        gone, marked["doc_id"].eqNullSafe(gone["_id"]) & (marked["_mark"] == gone["_gone"]), "left_anti"
    )
    repeated = found.where("kept AND n_shingles > 0").groupBy("doc_id", "_mark").count().where("count > 1")
    if not repeated.isEmpty():  # rows that repeat id and text are one group too
        kept = kept.dropDuplicates(["doc_id", "_mark"])
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights of domains, languages and sources.

    Null languages and sources are groups of their own, of weight 1. Documents without words cost nothing. A leaf's
    order is that of a hash of the id, so rows that repeat an id are drawn together. Documents are not cut: a leaf
    ends before the first id that does not fit its budget. Any other column passes through.
    """
    weights = {"domain": DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS}
    wrapped = _wrapped(docs, "doc_id", "text", "lang", "source")
    return mixing.mix(wrapped, domain_of(), weights, share=MIX_SHARE, max_epochs=MIX_EPOCHS).select("_doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, each with its sequence and place there.

    A null or empty text is one piece, the end; texts of any length are encoded whole and cut. Rows that repeat an id
    are packed each. A null id stays null. Only the columns of pieces come out.
    """
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), CAPACITY)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what a stage leaves on the way is deleted once it is written."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        with scratch_scope(spark):
            found = stage(spark, docs, sf_dir)
            path = new_path(spark, f"stage-{name}")
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return docs
