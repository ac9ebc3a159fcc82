"""Training-corpus pipeline over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with
their columns (the last returns token ids); ``run`` writes each stage's result as
Parquet in the shared folder and rereads it, so a lost executor never repeats
earlier stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.llm import decontam, dsir, line_dedup, ngram_join, sp_codec
from retailcast.llm.queries import SP_MODEL, table
from retailcast.session import ensure_checkpoint_dir, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    ensure_checkpoint_dir(spark)
    return dsir.quality_filter(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more documents share, but for each line's first
    occurrence (by document id and position): no line is lost. Every document stays, with its text
    and ``n_chars`` (code points) as they are afterwards.

    A document that would be left with blank lines only keeps its text: such are further
    copies of a text held ten times or more, of which the next stage keeps one. Near copies
    of a large group keep their own lines, and the first of them the shared ones.
    """
    ensure_checkpoint_dir(spark)
    words = line_dedup.dropped_words(docs.select("doc_id", F.col("text").cast("string").alias("text")), keep_first=True)
    cleaned, kept = line_dedup.apply_words(docs, words), F.col("_dedup.kept")
    value = {"text": kept, "n_chars": F.char_length(kept).cast("long")}
    cut = (F.col("_dedup.n_dropped") > 0) & (F.btrim(kept, F.lit(line_dedup.BLANKS)) != "")
    return cleaned.select(*[F.when(cut, value[c]).otherwise(F.col(c)).alias(c) if c in value else F.col(c)
                            for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: the one with the least id.

    Of repeated rows with that id one stays; rows without an id stay.
    """
    ensure_checkpoint_dir(spark)
    found = ngram_join.jaccard_components(docs.select("doc_id", "text"))
    gone = materialize(found.filter("component_id <> doc_id").select("doc_id").distinct(), "gone")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    twice = materialize(found.filter("component_id = doc_id").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.first(F.struct(*docs.columns)).alias("x")).select("x.*")
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return sp_codec.encode(docs, sp_codec.model_bytes(SP_MODEL))


STAGES = [("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
          ("benchmark_decontamination", decontaminated), ("sentencepiece", tokens)]

#: SQL can't express the classifier's models and the segmentation; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
