"""Line dedup over a corpus, DataFrame functions only.

Lines are keyed by two 64-bit hashes of the stripped, A-Z lower-cased line
(128 bits). The hashes are range-partitioned with a secondary sort by document
and position: the range also covers the document, so a line held by a third of
all documents is spread over many partitions, and each partition streams the
first occurrence of a key in each document from its sorted rows. Counts are
combined before the second, small shuffle. The result is a compressed bitmap
per document (64 lines a word, words without a dropped line left out), not text.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.session import materialize

# ---- fixed values: white space of a line's ends ----
BLANKS = " \t\n\x0b\x0c\r"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def line_positions(docs: DataFrame, min_length: int = 1) -> DataFrame:
    """(h1, h2, doc_id, version, first, positions): one row per key and document,
    sorted by key, document and position within range partitions."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("version"), F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("pos", "key"))
    keyed = lines.filter(F.char_length("key") >= max(min_length, 1)).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "version", "pos")
    group = ["h1", "h2", "doc_id", "version"]
    return (keyed.repartitionByRange(*group).sortWithinPartitions(*group, "pos")
            .groupBy(*group).agg(F.min("pos").alias("first"), F.collect_list("pos").alias("positions")))


def dropped_words(docs: DataFrame, min_docs: int = 10, min_length: int = 1, keep_first: bool = False) -> DataFrame:
    """Compressed keep bitmaps: (doc_id, version, words). Bit i of word w is set
    when line 64 w + i goes; a document or word not listed keeps all its lines.

    ``keep_first`` spares a line's first occurrence by document id and position.
    """
    found = materialize(line_positions(docs, min_length), "lines")
    common = (found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "version", "first")).alias("at"))
              .filter(F.col("n") >= min_docs).drop("n"))
    common = materialize(common, "common_lines")        # a plain table on this side: the join's hot keys can be split
    gone = found.join(common, ["h1", "h2"]).select("doc_id", "version", F.explode("positions").alias("pos"), "at")
    if keep_first:
        gone = gone.filter(~F.struct("doc_id", "version", F.col("pos").alias("first")).eqNullSafe(F.col("at")))
    return (gone.groupBy("doc_id", "version", F.floor(F.col("pos") / 64).cast("int").alias("w"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("b"))
            .groupBy("doc_id", "version").agg(F.map_from_entries(F.collect_list(F.struct("w", "b"))).alias("words")))


def apply_words(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``docs`` with ``_dedup``: n_lines, n_dropped and kept (the lines left, joined by newlines)."""
    words = words.select(F.col("doc_id").alias("_dedup_id"), F.col("version").alias("_dedup_version"), F.expr(
        "transform(sequence(0, array_max(map_keys(words))), w -> coalesce(words[w], 0L))").alias("_dedup_words"))
    joined = docs.join(words, F.col("doc_id").eqNullSafe(F.col("_dedup_id")) & (F.xxhash64("text") == F.col("_dedup_version")), "left")
    lines = split_lines(F.col("text"))
    left = F.col("_dedup_left")
    kept = F.when(F.col("_dedup_words").isNull(), lines).otherwise(F.filter(lines, _stays))
    return (joined.withColumn("_dedup_left", kept)
            .withColumn("_dedup", F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(left)).cast("long").alias("n_dropped"),
                                           F.array_join(left, "\n").alias("kept")))
            .drop("_dedup_id", "_dedup_version", "_dedup_words", "_dedup_left"))


def _stays(line: Column, i: Column) -> Column:
    word = F.coalesce(F.get(F.col("_dedup_words"), F.floor(i / 64).cast("int")), F.lit(0).cast("long"))
    return F.getbit(word, i % 64) == 0


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped, kept) of every row of ``docs``.

    A key found in ``min_docs`` documents loses all its lines (or all but the
    first with ``keep_first``). A null or empty text is one empty line; keys
    shorter than ``min_length`` code points are never dropped. Each row counts as
    a document of its own, but equal rows (id and text) count once. Rows with a
    null id take part. Other columns are ignored; an empty table gives none.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return apply_words(docs, dropped_words(docs, **rule)).select("doc_id", "text", "_dedup.*")
