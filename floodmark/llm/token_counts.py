"""Token counts kept in a digest cache: only texts that no earlier run has counted are encoded."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.scratch import Scratch
from floodmark.llm.text import column

#: Missing digests (32 bytes each) that are sent to all tasks; more are found by a shuffle join.
BROADCAST_MISSES = 100_000
#: A digest is hot from this share of all rows, so at most as many digests as the inverse are; and from this many rows.
HOT_SHARE, HOT_ROWS = 1 / 2000, 1000
#: Bytes of text that one encoding task takes, where the session doesn't ask for less.
TASK_BYTES = 8 << 20
#: Characters from which a text is handed to the library in parts, where parts have the same tokens.
LONG = 1 << 16
#: Between a space and the word before it every split of the byte-level pattern has a border.
BORDER = re.compile(r"(?<=\w) (?=\w)")
STORED = "tokenizer string, digest binary, n_tokens long"


def normalised(text: Column) -> Column:
    """What is digested and encoded: null counts as empty; any other change could change the count."""
    return F.coalesce(text, F.lit(""))


def version(data: bytes) -> str:
    """Digest of everything a count depends on besides the text: the tokenizer file and the library that reads it."""
    return hashlib.sha256(f"tokenizers {tokenizers.__version__} ".encode() + data).hexdigest()


class Counter:
    """The tokenizer in one worker; special strings in texts as is its default, no truncation, no padding."""

    def __init__(self, data: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel part
        self.tokenizer = tokenizers.Tokenizer.from_str(data.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        rules = json.loads(data)
        split = rules.get("pre_tokenizer") or {}
        self.cuts = (
            rules.get("normalizer") is None and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space", True)
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in rules["added_tokens"])
        )

    def parts(self, text: str) -> list[str]:
        """Parts of a long text that have its tokens together, so memory grows with a part (a text without a border
        is one)."""
        if not self.cuts or len(text) <= LONG:
            return [text]
        out, at = [], 0
        while len(text) - at > LONG:
            border = BORDER.search(text, at + LONG)
            if border is None:
                break
            out.append(text[at : border.start()])
            at = border.start()
        return [*out, text[at:]]

    def count(self, texts: list[str]) -> list[int]:
        parts = [self.parts(t) for t in texts]
        sizes: list[int] = []
        flat = [p for some in parts for p in some]
        for at in range(0, len(flat), 16):
            coded = self.tokenizer.encode_batch_fast(flat[at : at + 16], add_special_tokens=False)
            sizes += [len(e.ids) for e in coded]
        out, at = [], 0
        for some in parts:
            out.append(sum(sizes[at : at + len(some)]))
            at += len(some)
        return out


_counters: dict[str, Counter] = {}


def _counter(data: bytes) -> Counter:
    key = version(data)
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(data)
    return _counters[key]


@contextmanager
def _at_most(spark: SparkSession, key: str, most: int):
    """A setting in bytes held at `most` or what it is below, while a job runs."""
    before = spark.conf.get(key)
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(key, str(min(now, most)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of a cache, one row per digest; a folder that is not there is an empty cache.

    Two runs may append the same digests, or one twice after a lost executor: they hold the same counts.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(STORED).parquet(cache).filter(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, path: str, cache: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text",
    scratch: Scratch | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, n_bytes long (UTF-8), n_tokens long, over_limit boolean (n_tokens > limit).

    `path` is a file of the tokenizers library; no special tokens are added. `cache` is a folder of counts by digest of
    text and tokenizer version, shared by all runs, made if missing and appended to: digests of all rows are joined to
    it, each distinct text it lacks is encoded once, however many rows have it, and its count is stored. Another
    tokenizer file or library version finds none of the old counts.

    Null text counts as empty (0 bytes, 0 tokens). Null and repeated ids, repeated texts and other columns don't matter;
    an empty table gives no row and stores nothing. Whole texts are counted; long ones are encoded in parts between
    words where the tokenizer allows it. A digest held by a large share of rows meets its count in every task.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    with open(path, "rb") as f:
        data = f.read()
    tokenizer = version(data)
    shared = spark.sparkContext.broadcast(data)

    text = normalised(column(text_col))
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    rows = scratch.keep(docs.select(column(id_col).alias("id"), digest, F.octet_length(text).cast("long").alias("n_bytes")))
    sizes = scratch.keep(rows.groupBy("digest").count())
    misses = scratch.keep(sizes.select("digest").join(stored(spark, cache, tokenizer), "digest", "left_anti"))
    n_misses = misses.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            counts = counter.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    if n_misses:
        texts = docs.select(digest, text.alias("text"))
        if n_misses <= BROADCAST_MISSES:
            new = texts.join(F.broadcast(misses), "digest", "left_semi").dropDuplicates(["digest"])
        else:
            new = texts.dropDuplicates(["digest"]).join(misses, "digest", "left_semi")
        counted = map_batches(new, run, "digest binary, n_tokens long")
        with _at_most(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES):
            counted.select(F.lit(tokenizer).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache)

    counts = stored(spark, cache, tokenizer).join(sizes.select("digest"), "digest", "left_semi")
    total = rows.count()
    hot = sizes.filter(F.col("count") > max(HOT_ROWS, HOT_SHARE * total)).select("digest")
    few = F.broadcast(counts.join(F.broadcast(hot), "digest", "left_semi"))
    rest = rows.join(F.broadcast(hot), "digest", "left_anti").join(counts, "digest")
    return rows.join(few, "digest").unionByName(rest).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
