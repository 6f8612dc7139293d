"""Quality rules per document and per host, with rates shrunk by an empirical beta prior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.scratch import Scratch
from floodmark.llm.text import column, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.8


def _from(name: str, first: int) -> Column:
    return F.slice(name, first, F.greatest(F.size(name) - first + 1, F.lit(0)))


def _turned(h: Column) -> Column:
    """A 64-bit hash turned by 21 bits, so that the place of a word in its window counts."""
    return F.shiftleft(h, 21).bitwiseOR(F.shiftrightunsigned(h, 43))


def _placed(windows: str) -> Column:
    """Each window's hash with its position."""
    return F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; all text is read.

    Repeated words: three-word windows are hashed (64 bits), sorted by (hash, position) and compared with their neighbours, and the
    covered positions counted once each, so the cost is n log n in the length of the text.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select("*", words(text).alias("_words"), lines.alias("_lines"))
    w = F.col("_words")
    # Each step is a column that the next reads twice or more, so that it is computed once and not inside a lambda.
    hashed = split.withColumn("_h", F.transform(w, lambda x: F.xxhash64(x)))
    pairs = hashed.withColumn("_pairs", F.zip_with("_h", _from("_h", 2), lambda x, y: _turned(x).bitwiseXOR(y)))
    # zip_with pads the shorter side with null; the last two positions start no window.
    windows = pairs.withColumn("_windows", F.slice(
        F.zip_with("_pairs", _from("_h", 3), lambda x, y: _turned(x).bitwiseXOR(y)),
        1, F.greatest(F.size("_h") - 2, F.lit(0)),
    ))
    placed = windows.withColumn("_placed", F.when(
        F.size(F.array_distinct("_windows")) == F.size("_windows"), F.slice(_placed("_windows"), 1, 0)
    ).otherwise(F.sort_array(_placed("_windows"))))
    same = placed.withColumn("_same", F.zip_with(
        "_placed", _from("_placed", 2), lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))))
    again = F.zip_with("_same", F.concat(F.array(F.lit(False)), F.col("_same")), lambda x, y: F.coalesce(x, F.lit(False)) | y)
    covered = F.flatten(F.filter(F.zip_with(
        again, "_placed", lambda f, x: F.when(f, F.array(x["i"], x["i"] + 1, x["i"] + 2))), F.isnotnull))
    measured = same.select(
        *[column(c) for c in docs.columns],
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def host_rates(measured: DataFrame, host: Column) -> DataFrame:
    """(host, n_docs, n_failed, rate) per host: rate is the mean of the posterior under a beta prior fitted to all hosts.

    The prior is fitted by moments over hosts (mean m, variance v of the raw rates, each host counted once):
    strength m(1-m)/v - 1, held between 1 and 1000; with fewer than two hosts, or no spread, strength 1000 or 1 as the
    limits give. Rows without a host form one host of their own.
    """
    hosts = measured.groupBy(host.alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    raw = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(raw).alias("m"), F.coalesce(F.var_pop(raw), F.lit(0.0)).alias("v"))
    strength = F.greatest(F.lit(1.0), F.least(F.lit(1000.0), F.coalesce(
        F.col("m") * (1 - F.col("m")) / F.nullif(F.col("v"), F.lit(0.0)) - 1, F.lit(1000.0))))
    # One row of prior beside every host; its size does not depend on the data.
    return hosts.join(F.broadcast(prior), F.lit(True)).select(
        "host", "n_docs", "n_failed",
        ((F.col("n_failed") + F.col("m") * strength) / (F.col("n_docs") + strength)).alias("rate"),
    )


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str, max_host_rate: float) -> DataFrame:
    """quality_rules with the row's key (_id, _hash of the text, _host)."""
    narrow = docs.select(
        column(id_col).alias("_id"), F.xxhash64(column(text_col)).alias("_hash"), column(text_col).alias("_text"),
        column(host_col).cast("string").alias("_host"),
    )
    measured = Scratch(docs.sparkSession).keep(measures(narrow, "_text").drop("_text"))
    rates = host_rates(measured, F.col("_host"))
    by_host = rates.select("host", F.col("rate").alias("host_rate"))
    joined = measured.join(by_host, measured["_host"].eqNullSafe(by_host["host"]), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """One row per row of `docs`: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    host_rate, kept.

    A document stays unless it fails a rule itself or its host's shrunk failure rate is above `max_host_rate`. Null
    text has no words and fails; a null host is a host of its own; a null id, repeated rows and other columns change
    nothing: each row gives one row. An empty table gives none. Text is read once and not shuffled: rows are measured
    into a narrow table first, and hosts are summed before they move.
    """
    return _judged(docs, id_col, text_col, host_col, max_host_rate).select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "host_rate", "kept",
    )


def good_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    max_host_rate: float = MAX_HOST_RATE,
) -> DataFrame:
    """The rows of `docs` that quality_rules keeps, unchanged; rows are told apart by id, text and host."""
    kept = _judged(docs, id_col, text_col, host_col, max_host_rate).filter("kept").select(
        F.col("_id").alias("_kept_id"), F.col("_hash").alias("_kept_hash"), F.col("_host").alias("_kept_host")).distinct()
    same = (
        column(id_col).eqNullSafe(F.col("_kept_id")) & (F.xxhash64(column(text_col)) == F.col("_kept_hash"))
        & column(host_col).cast("string").eqNullSafe(F.col("_kept_host"))
    )
    return docs.join(kept, same, "left_semi")
