"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.scratch import Scratch
from floodmark.llm.text import column

LIMIT_BYTES = 1_000_000
#: Bits of the hash, from the front of MD5, and levels looked at in one pass.
BITS, LEVELS = 60, 6


def row_hash(key: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of key and text digest as a number; nulls hash as empty."""
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    both = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), own)
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def directory(cells: DataFrame, limit: int, scratch: Scratch) -> DataFrame:
    """(h, depth, shard_bytes) for each hash of `cells` (h, bytes; h distinct): the shortest prefix of its bits whose
    hashes fit the limit together, or that no other hash has.

    Buckets over the limit, and only they, go on to the next bits, six levels to a pass: a hash gives a prefix per
    level, and these are summed before they move. The passes follow from total bytes over the limit.
    """
    open_cells, done = cells, None
    for start in range(0, BITS + 1, LEVELS):
        levels = F.array(*map(F.lit, range(start, min(start + LEVELS, BITS + 1))))
        tried = open_cells.select("h", "bytes", F.explode(levels).alias("depth")).withColumn(
            "prefix", F.expr(f"shiftright(h, {BITS} - depth)"))
        sums = tried.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("n"))
        fits = sums.filter((F.col("shard_bytes") <= limit) | (F.col("n") == 1) | (F.col("depth") == BITS))
        hit = tried.join(fits, ["depth", "prefix"]).groupBy("h").agg(F.min(F.struct("depth", "shard_bytes")).alias("s"))
        settled = scratch.keep(open_cells.join(hit, "h", "left").select("h", "bytes", "s.depth", "s.shard_bytes"))
        closed = settled.filter("depth is not null").select("h", "depth", "shard_bytes")
        done = closed if done is None else done.unionByName(closed)
        open_cells = settled.filter("depth is null").select("h", "bytes")
        if open_cells.isEmpty():
            break
    return done


def assign_shards(
    docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_BYTES
) -> DataFrame:
    """One row per row of `docs`: key, n_bytes, shard, depth, part, shard_bytes.

    The directory is indexed by the leading bits of a hash of key and text. A bucket whose texts (UTF-8 bytes) are over
    `limit` together splits on the next bit, until each fits; `shard` is its prefix of `depth` bits, `shard_bytes` its
    size. A bucket of one hash cannot split: that is one row over the limit, a shard of its own, or equal rows, which go
    to overflow parts 0, 1, ... of as many as fit the limit (one at least). Elsewhere part is 0. Null and empty texts have
    0 bytes, a null key is a key of its own. An empty table gives none. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession)
    text = column(text_col)
    narrow = docs.select(
        column(key_col).alias("key"), row_hash(column(key_col), text).alias("h"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    classes = scratch.keep(narrow.groupBy("key", "h", "n_bytes").agg(F.count(F.lit(1)).alias("copies")))
    cells = classes.groupBy("h").agg(F.sum(F.col("n_bytes") * F.col("copies")).alias("bytes"))
    placed = classes.join(directory(scratch.keep(cells), limit, scratch), "h")
    each = placed.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    bits = F.lpad(F.bin(F.expr(f"shiftright(h, {BITS} - depth)")), F.col("depth"), F.lit("0"))
    return each.select(
        F.col("key").alias(key_col), "n_bytes", F.when(F.col("depth") == 0, "").otherwise(bits).alias("shard"), "depth",
        F.when(F.col("shard_bytes") > limit, F.floor(F.col("i") / room)).otherwise(0).cast("long").alias("part"),
        "shard_bytes",
    )
