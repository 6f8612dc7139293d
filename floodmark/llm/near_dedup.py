"""Near-duplicate documents by circulant MinHash, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.components import components
from floodmark.llm.scratch import Scratch
from floodmark.llm.shingles import band_keys, shingle_set, signature
from floodmark.llm.text import column

SHINGLE = 5
PERCENT = 85
BANDS, ROWS = 25, 5
#: A member is held against a pivot first if they share so many bands; all others are found by the prefix join.
LIKELY_BANDS = 6


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _print(items: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.empty(0, np.int64)
    for batch in batches:
        sizes, prints, bands = [], [], []
        for text in batch.column(1):
            found = shingle_set(text.as_py(), SHINGLE)
            sizes.append(len(found))
            prints.append(_print(found))
            bands.append(band_keys(signature(found, BANDS * ROWS)[None, :], ROWS)[0] if len(found) else none)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), _lists(bands)],
            ["id", "hash", "n", "print", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of rows (id, text, print); a row whose text has another print shares its id with the one meant."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            ids, sets = [], []
            for name, text, want in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                found = shingle_set(text, SHINGLE)
                if _print(found) == want:
                    ids.append(name)
                    sets.append(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists(sets)], ["id", "items"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    If `sets` names the one source of a set in a column `only`, two sets of the same one source are not linked.
    """
    only = F.col("only") if "only" in sets.columns else F.lit(None).cast("bigint")
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"), only.alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"), only.alias("of_b"))
    same = F.size(F.array_intersect("x", "y")).cast("long")
    met = pairs.join(left, "a").join(right, "b").filter("of_a is null or of_b is null or of_a <> of_b")
    both = met.select("a", "b", same.alias("same"), (F.size("x") + F.size("y")).alias("sizes"))
    return both.filter(100 * F.col("same") >= percent * (F.col("sizes") - F.col("same"))).select("a", "b")


def _pivot_pairs(members: DataFrame, likely: int) -> DataFrame:
    """Pairs of a member and its bucket's pivot, the member with the most bucket mates over all bands."""
    score = members.groupBy("id").agg(F.sum("size").alias("score"))
    scored = members.join(score, "id").select("key", "id", F.struct("score", (-F.col("id")).alias("low")).alias("rank"))
    pivots = scored.groupBy("key").agg(F.max("rank").alias("top")).select("key", (-F.col("top.low")).alias("pivot"))
    shared = scored.join(pivots, "key").filter("id <> pivot").groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("bands"))
    return shared.filter(F.col("bands") >= likely).select(F.col("id").alias("a"), F.col("pivot").alias("b"))


def _prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs of different components in `rest` (id, part) that can be linked.

    Two sets of similarity t share an item among the first n - ceil(t n) + 1 of each, in any common order of items;
    here rare items come first, and the places of the first shared item bound the intersection. An item's pairs are formed between documents outside its most frequent component and
    all others, so a large group that is linked already costs nothing.
    """
    held = rest.join(sets.select("id", "items"), "id").select("id", "part", F.explode("items").alias("item"), F.size("items").alias("n"))
    shared = held.groupBy("item").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    # Items of one document sort first and link nothing, so only their number matters.
    common = held.join(shared, "item").groupBy("id", "part", "n").agg(F.collect_list(F.struct("df", "item")).alias("items"))
    length = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    single = F.col("n") - F.size("items")
    room = (length - single).cast("int")
    first_items = F.slice(F.sort_array("items"), 1, room)["item"]
    placed = common.filter(room > 0).select("id", "part", "n", single.alias("single"), F.posexplode(first_items).alias("at", "item"))
    prefix = scratch.keep(placed.select("id", "part", "n", (F.col("single") + F.col("at")).alias("at"), "item"))
    counts = prefix.groupBy("item", "part").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("item").agg(F.max(F.struct("c", "part"))["part"].alias("main"), F.count(F.lit(1)).alias("parts"))
    open_items = prefix.join(main.filter("parts > 1").select("item", "main"), "item")
    outside = open_items.filter("part <> main").select("item", F.col("id").alias("a"), F.col("part").alias("pa"), F.col("n").alias("na"), F.col("at").alias("ia"))
    anyone = open_items.select(
        "item", F.col("id").alias("b"), F.col("part").alias("pb"), F.col("n").alias("nb"), F.col("at").alias("ib"),
        (F.col("part") == F.col("main")).alias("inside"),
    )
    # At the first item that two sets share, what follows bounds the whole intersection.
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    can = ((100 + percent) * most >= percent * (F.col("na") + F.col("nb"))) & (F.col("pa") != F.col("pb"))
    met = outside.join(anyone, "item").filter(can & (F.col("inside") | (F.col("a") < F.col("b"))))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked_components(members: DataFrame, sets: DataFrame, percent: int, likely: int, scratch: Scratch) -> DataFrame:
    """(node, component) of all links among `members` (key, id, size of the bucket), with `sets` (id, items).

    First each member is held against the pivots with which it shares `likely` buckets. Where a bucket then still spans
    components, the prefix join finds every other pair. All pairs are checked on full sets.
    """
    near = scratch.keep(_linked(_pivot_pairs(members, likely), sets, percent))
    parts = components(near, scratch)
    part = members.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
    part = scratch.keep(part.select("key", "id", "part"))
    mixed = part.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo <> hi").select("key")
    rest = scratch.keep(part.join(mixed, "key", "left_semi").select("id", "part").distinct())
    more = _linked(_prefix_pairs(rest, sets, percent, scratch), sets, percent)

    return components(near.unionByName(more), scratch)


def _classified(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """near_duplicates as (id, hash of the text, n, low, kept)."""
    scratch = Scratch(docs.sparkSession)
    text = column(text_col)
    narrow = docs.select(column(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    features = scratch.keep(map_batches(narrow, _features, "id long, hash long, n long, print binary, bands array<long>"))

    named = features.filter("n > 0 and id is not null")
    classes = scratch.keep(named.groupBy("print").agg(F.min("id").alias("first")))
    first = classes.select(F.col("first").alias("id"), "print")
    entries = named.join(first, ["id", "print"]).select("id", F.explode("bands").alias("key")).distinct()
    sizes = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = scratch.keep(entries.join(sizes, "key").select("key", "id", "size"))

    wanted = first.join(members.select("id").distinct(), "id")
    texts = narrow.filter("id is not null").join(wanted, "id").select("id", "text", "print")
    sets = scratch.keep(map_batches(texts, _sets, "id long, items array<long>"))

    label = linked_components(members, sets, percent, LIKELY_BANDS, scratch)
    whole = (
        features.join(classes, "print", "left")
        .join(label.withColumnRenamed("node", "first"), "first", "left")
        .select("id", "hash", "n", F.when(F.col("id").isNotNull(), F.least("component", "first", "id")).alias("low"))
    )
    return whole.withColumn("kept", F.coalesce(F.col("low") == F.col("id"), F.lit(True)))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id, kept.

    A document's set is its distinct five-word shingles (A-Z lower-cased, ASCII white space). Documents are linked if
    100 * intersection >= percent * union; component_id is the smallest id reachable, kept tells whether that is the
    row's own. Null or blank text has no shingle and links with nothing. A null id cannot be named: the row keeps a null
    component and stays. Rows that share an id are each judged by their own text. Other columns are not looked at. An empty table gives none.

    Documents with equal sets are one class, found by grouping on a 128-bit hash. One row per class goes into the bands
    (25 of 5 circulant coordinates; at similarity 0.85 a pair is missed with probability 4e-7). In each bucket all are
    held against one pivot; where a bucket then still spans components, an exact prefix join finds every other pair.
    All pairs are checked on full sets. No bucket is held in one task, and no pairs within a bucket are listed.
    """
    return _classified(docs, id_col, text_col, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("low").alias("component_id"), "kept"
    )


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The rows of `docs` that near_duplicates keeps, unchanged; of rows equal in id and text one stays, the first by
    the other columns. Rows with a null id all stay."""
    kept = _classified(docs, id_col, text_col, percent).filter("kept and id is not null").select("id", "hash").distinct()
    hashed = docs.select(F.struct("*").alias("row"), column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("hash"))
    others = [F.col("row")[c] for c in docs.columns if c != text_col]
    first = F.row_number().over(Window.partitionBy("id", "hash").orderBy(*others))
    single = hashed.filter("id is not null").withColumn("_n", first).filter("_n = 1").drop("_n")
    rows = single.join(kept, ["id", "hash"], "left_semi").unionByName(hashed.filter("id is null"))
    return rows.select("row.*")
