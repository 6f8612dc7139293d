"""Repeated passages by MinHash over paragraphs, exact verification and components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.near_dedup import linked_components
from floodmark.llm.scratch import Scratch
from floodmark.llm.shingles import hashes_of, mix, permutation, places, shingle_rows, word_hashes
from floodmark.llm.text import column

SHINGLE = 5
PERCENT = 80
#: Bands of one coordinate: a pair of similarity s meets with probability 1 - (1 - s)^bands. Lines have five, 0.9997 at
#: 0.8; windows two, 0.96 at 0.8. Equal paragraphs always meet.
BANDS, WINDOW_BANDS = 5, 2
#: Words of the shortest line that is a paragraph. Documents of more than LONG words are also cut into windows of WINDOW
#: words across line breaks, one at least in each ANCHOR places, so that they leave no gap (ANCHOR <= WINDOW).
SHORTEST, LONG, WINDOW, ANCHOR = 20, 50, 16, 16

#: Buckets are gone through in so many slices, so that only a part of their entries is on the disks at a time.
SLICES = 3


def _parts(percent: int) -> int:
    """Two more than two linked windows can differ in shingles: of m shingles each at most, 2m(1 - t)/(1 + t)."""
    return 2 * (WINDOW - SHINGLE + 1) * (100 - percent) // (100 + percent) + 2


def _windows(lines: np.ndarray, base: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """First words of the windows of some documents in a row: `lines` has the words of each line, `base` the bounds of the
    documents, `rows` the shingles of all words in order.

    An anchor is the place of the least of each ANCHOR numbers in a row, the last of ties: the same in any context.
    """
    begin, end = base[:-1], base[1:]
    long = end - begin > LONG
    if not long.any():
        return np.empty(0, np.int64)
    last = _last_lowest(mix(rows ^ np.uint64(0x5851F42D4C957F2D)), ANCHOR)
    doc = np.repeat(np.arange(len(begin)), end - begin)
    first = doc[: len(last)]
    inside = long[first] & (np.arange(len(last)) + ANCHOR - 1 <= end[first] - SHINGLE)
    last = last[inside]
    last = last[np.flatnonzero(np.diff(last, prepend=-1))]
    # Windows at the end reach back to have their full length; the first and the last stand at the document's ends.
    reach = (end - WINDOW)[doc[last]]
    starts = _different(np.concatenate([np.minimum(last, reach), begin[long], end[long] - WINDOW]))
    # A document's paragraphs are told apart by their first word: a window that starts with a line starts one word
    # later. It shares 11 of 13 shingles with the window it stands for.
    whole = (np.cumsum(lines) - lines)[lines >= SHORTEST]
    return _different(starts + _among(starts, whole))


def _different(values: np.ndarray) -> np.ndarray:
    """The different values in order."""
    ordered = np.sort(values)
    return ordered[np.concatenate([ordered[:1] == ordered[:1], ordered[1:] != ordered[:-1]])]


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values are in the sorted array `ordered`."""
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row; each step reaches twice as far, so it takes log(width) passes."""
    reach = 1
    while reach < width and len(values):
        step = min(reach, width - reach)
        values = np.minimum(values[:-step], values[step:])
        reach += step
    return values


def _last_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the least of each `width` values in a row, the last of ties."""
    at, reach = np.arange(len(values)), 1
    while reach < width and len(values):
        step = min(reach, width - reach)
        behind = values[step:] <= values[:-step]
        at = np.where(behind, at[step:], at[:-step])
        values = np.where(behind, values[step:], values[:-step])
        reach += step
    return at


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums of 64-bit numbers, from 0: the sum of a stretch is the difference of two."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])


def _repeating_windows(rows: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of the `starts` may have an item of `rows` twice among their `width`: all that have, few others."""
    again = np.zeros(len(rows), dtype=np.int64)
    for step in range(1, min(width, len(rows))):
        again[:-step] |= rows[step:] == rows[:-step]
    seen = np.concatenate([[0], np.cumsum(again)])
    return np.flatnonzero(seen[starts + width] > seen[starts])


def _ragged(rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, offsets): the shingles in `rows` of paragraphs of so many words, one after the other, and where each begins."""
    count = sizes - SHINGLE + 1
    offsets = np.cumsum(count) - count
    return np.arange(count.sum()) - np.repeat(offsets - starts, count), offsets


def _fresh(items: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which items are the first of their value in their set; the sets follow one another and begin at `offsets`.

    Only items whose value, hashed with the set, is there twice are put in order.
    """
    owner = np.repeat(np.arange(len(offsets)), np.diff(offsets, append=len(items)))
    named = items ^ mix(owner.astype(np.uint64) + np.uint64(1))
    ordered = np.sort(named)
    at = np.flatnonzero(_among(named, ordered[1:][ordered[1:] == ordered[:-1]]))
    at = at[np.lexsort((items[at], owner[at]))]
    fresh = np.ones(len(items), dtype=bool)
    fresh[at[1:][(items[at[1:]] == items[at[:-1]]) & (owner[at[1:]] == owner[at[:-1]])]] = False
    return fresh


def paragraph_table(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """owner, first word, words, print, keys of all paragraphs of some texts: int64 arrays, keys of shape (n, BANDS), of
    which windows use the first WINDOW_BANDS."""
    return _paragraphs(texts, PERCENT)[:5]


def _paragraphs(texts: list[str | None], percent: int) -> tuple[np.ndarray, ...]:
    """paragraph_table and parts, int32 of shape (n, _parts(percent)): hashes of a window's shingles, dealt out to so many
    parts; of a line the first is 1 if it has so few different shingles that it can be linked with a window, else 0."""
    lines = [[line.split() for line in (t or "").encode("utf-8", "surrogatepass").lower().split(b"\n")] for t in texts]
    counts = [[len(line) for line in doc] for doc in lines]
    base = np.cumsum([0, *map(sum, counts)])
    found = chain.from_iterable(chain.from_iterable(lines))
    words = hashes_of(found, base[-1])
    n_parts, m = _parts(percent), WINDOW - SHINGLE + 1
    if len(words) < SHINGLE:
        none = np.empty(0, np.int64)
        return none, none, none, none, none.reshape(0, BANDS), np.empty((0, n_parts), np.int32)
    rows = shingle_rows(words, SHINGLE)
    sizes = np.concatenate([np.array(c, dtype=np.int64) for c in counts])
    windows = _windows(sizes, base, rows)
    whole = (np.cumsum(sizes) - sizes)[sizes >= SHORTEST]
    sizes = sizes[sizes >= SHORTEST]
    order, at, high = permutation(42, BANDS), places(rows), rows >> np.uint64(22)
    bounds = np.stack([whole, whole + sizes - SHINGLE + 1], axis=1).ravel()

    keys = np.zeros((len(windows) + len(whole), BANDS), dtype=np.uint64)
    for k in range(BANDS if len(whole) else WINDOW_BANDS):
        # The shingle stands behind its rank, so that a coordinate names it and not just its place in the universe.
        ranked = (order[at + k].astype(np.uint64) << np.uint64(42)) | high
        if k < WINDOW_BANDS and len(windows):
            keys[: len(windows), k] = mix(_lowest(ranked, m)[windows]) + np.uint64(k + 1)
        if len(whole):
            lowest = np.minimum.reduceat(np.append(ranked, np.uint64(0)), bounds)[::2]
            keys[len(windows) :, k] = mix(lowest) + np.uint64(k + 1)

    # Sums over distinct shingles are differences of running sums; the few paragraphs with a repeated one are summed again.
    hashed, part = mix(rows), (rows >> np.uint64(32)) % np.uint64(n_parts)
    total = _sums(hashed)
    prints = np.zeros(len(keys), dtype=np.uint64)
    parts = np.zeros((len(keys), n_parts), dtype=np.int32)
    if len(windows):
        again = _repeating_windows(rows, windows, m)
        items = rows[windows[again][:, None] + np.arange(m)]
        prints[: len(windows)] = mix(total[windows + m] - total[windows])
        prints[again] = set_print(items)
        items = np.sort(items, axis=1)
        fresh = np.ones(items.shape, dtype=bool)
        fresh[:, 1:] = items[:, 1:] != items[:, :-1]
        fresh_hashed, fresh_part = mix(items) * fresh, (items >> np.uint64(32)) % np.uint64(n_parts)
        for k in range(n_parts):
            dealt = _sums(hashed * (part == k))
            of_part = dealt[windows + m] - dealt[windows]
            of_part[again] = (fresh_hashed * (fresh_part == k)).sum(axis=1, dtype=np.uint64)
            parts[: len(windows), k] = (mix(of_part) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    if len(whole):
        index, offsets = _ragged(rows, whole, sizes)
        fresh = _fresh(rows[index], offsets)
        prints[len(windows) :] = mix(np.add.reduceat(hashed[index] * fresh, offsets))
        parts[len(windows) :, 0] = percent * np.add.reduceat(fresh.astype(np.int64), offsets) <= 100 * m
    first = np.concatenate([windows, whole])
    size = np.concatenate([np.full(len(windows), WINDOW), sizes])
    owner = np.searchsorted(base, first, "right") - 1
    return (
        owner, first - base[owner], size, prints.view(np.int64), mix(keys).view(np.int64), parts,
    )


def set_print(items: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the set in each row: the sum of its distinct items, mixed."""
    found = np.sort(items, axis=1)
    fresh = np.ones(found.shape, dtype=np.uint64)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    return mix((mix(found) * fresh).sum(axis=1, dtype=np.uint64))


def _features(batches: Iterator[pa.RecordBatch], percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    """Paragraphs of rows (row, id, text): the columns of _schema."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            owner, first, size, prints, keys, parts = _paragraphs(part.column(2).to_pylist(), percent)
            take = pa.array(owner)
            line = size > WINDOW
            bounds = np.concatenate([[0], np.cumsum(np.where(line, BANDS, 0))]).astype(np.int32)
            packed = np.zeros((len(owner), 2 * _packs(percent)), dtype=np.int32)
            packed[:, : parts.shape[1]] = parts
            packed = packed.view("<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(take), part.column(1).take(take),
                    pa.array(first.astype(np.int64) << 32 | size.astype(np.int64)), pa.array(prints),
                    *(pa.array(np.ascontiguousarray(keys[:, k])) for k in range(WINDOW_BANDS)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[line].ravel()), mask=pa.array(~line)),
                    *(pa.array(np.ascontiguousarray(packed[:, k])) for k in range(packed.shape[1])),
                ],
                [c.split()[0] for c in _schema("any", percent)],
            )


def _packs(percent: int) -> int:
    return (_parts(percent) + 1) // 2


def _schema(kind: str, percent: int) -> list[str]:
    """`at` is the first word times 2^32 plus the words, `more` all keys of a line (null for windows), a `q` holds two parts."""
    keys = [f"k{k} long" for k in range(WINDOW_BANDS)]
    return ["row long", f"id {kind}", "at long", "print long", *keys, "more array<long>", *(f"q{k} long" for k in range(_packs(percent)))]


def _low(column: str) -> Column:
    """The lower 32 bits of a long as a signed number."""
    return F.shiftright(F.shiftleft(column, 32), 32).cast("int")


def _high(column: str) -> Column:
    return F.shiftright(column, 32).cast("int")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the wanted paragraphs (array of place and only) of rows (text, wanted)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            words = [word_hashes(t) for t in part.column(0).to_pylist()]
            wanted = part.column(1)
            units = wanted.flatten()
            base = np.repeat(np.cumsum([0, *map(len, words[:-1])]), np.diff(wanted.offsets.to_numpy()))
            rows = shingle_rows(np.concatenate(words), SHINGLE)
            place = units.field("at").to_numpy()
            index, offsets = _ragged(rows, base + (place >> 32), place & 0xFFFFFFFF)
            items = rows[index]
            fresh = _fresh(items, offsets)
            lengths = np.add.reduceat(fresh.astype(np.int32), offsets)
            bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mix(np.add.reduceat(mix(items) * fresh, offsets)).view(np.int64)), units.field("only"),
                    pa.ListArray.from_arrays(bounds, pa.array(items[fresh].view(np.int64))),
                ],
                ["id", "only", "items"],
            )


def _members(met: DataFrame, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): of the paragraphs `met` in buckets of several documents (id, lo, hi, at), the ids, first and last row
    and place in the first one of all different ones, and (key, id, size) of those that can be linked.

    Two linked windows have two parts of their shingles in common at least, as they differ in two parts fewer than there
    are: so each pair of parts is a narrower bucket, in which all linked ones meet. Lines stay in their buckets, and so do
    windows beside a line that is short enough to be linked with them. No pairs are formed.
    """
    n = _parts(percent)
    part = [(_high if k % 2 else _low)(f"q{k // 2}") for k in range(n)]
    least = [F.min(p).alias(f"p{k}") for k, p in enumerate(part)]
    where = F.min_by("at", "row").alias("at")
    grouped = met.groupBy(F.col("print").alias("id")).agg(F.min(_low("at")).alias("size"), F.min("row").alias("lo"), F.max("row").alias("hi"), where, *least)
    nodes = scratch.keep(grouped)
    both = [F.xxhash64(F.lit(i * n + j), f"p{i}", f"p{j}") for i in range(n) for j in range(i + 1, n)]
    cells = nodes.filter(F.col("size") == WINDOW).select("id", "lo", "hi", F.explode(F.array(*both)).alias("key"))
    count = F.count(F.lit(1)).alias("size")
    shared = cells.groupBy("key").agg(count, F.min("lo").alias("least"), F.max("hi").alias("most"))
    shared = shared.filter("size > 1 and least <> most").select("key", "size")
    windows = cells.join(shared.hint("shuffle_hash"), "key").select("key", "id", "size")

    line = _low("at") > WINDOW
    beside = met.filter(line & (part[0] == 1)).select("key").distinct()
    lines = met.filter(line).select("key", F.col("print").alias("id"))
    lines = lines.unionByName(met.filter(~line).join(beside, "key", "left_semi").select("key", F.col("print").alias("id"))).distinct()
    sizes = lines.groupBy("key").agg(count).filter("size > 1")
    return nodes.select("id", "lo", "hi", "at"), scratch.keep(windows.unionByName(lines.join(sizes, "key").select("key", "id", "size")))


def repeated_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per paragraph that occurs in two documents or more: id, first_word, n_words, component_id, n_copies, removed.

    Paragraphs are all lines of 20 words or more, whole, and in documents of more than 50 words windows of 16 words over
    the whole word sequence, across line breaks, at places that depend on the words alone and without gaps: a passage of
    31 words in any surroundings has a whole one, and all of it but 15 words at most at either end is in such windows
    (matches are not extended to the ends). One that would start with a line of 20 words starts a word later. Two are linked if their distinct
    five-word shingles (A-Z lower-cased, ASCII white space) have 100 * intersection >= percent * union and they occur in
    different documents; windows of one document overlap and are no copies of each other. component_id is
    a number of the component, n_copies its paragraphs; removed is false for the first occurrence (smallest id, then
    place) and true for all others. Null and blank texts have no paragraph. Rows equal in id and text are
    one document; a null id is an id, the smallest. Other columns are not looked at; an empty table gives none.

    Equal paragraphs are one node, found by grouping on a 64-bit hash; only different ones that share a bucket are
    compared, on full sets, so what a passage's thousands of copies cost is a sum. Buckets of one document only, most of
    all, fall before any paragraph is moved: two paragraphs of one document are not compared, nor is one alone repeated.
    """
    scratch = Scratch(docs.sparkSession, free_shuffles=True)
    text = column(text_col)
    named = docs.select(F.xxhash64(column(id_col), text).alias("row"), column(id_col).alias("id"), text.alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    features = partial(_features, percent=percent)
    units = scratch.keep(map_batches(named, features, ", ".join(_schema(kind, percent))))

    # A bucket of two documents holds either different paragraphs or one that is repeated, and equal ones share all buckets.
    # The keys of these buckets are few beside the entries and different, so they are hashed and the entries not sorted.
    keys = F.explode(F.coalesce("more", F.array(*[f"k{k}" for k in range(WINDOW_BANDS)]))).alias("key")
    rows = units.select(keys, "row").groupBy("key").agg(F.min("row").alias("lo"), F.max("row").alias("hi"))
    across = scratch.keep(rows.filter("lo <> hi").select("key"))
    slices = []
    for k in range(SLICES):
        mine = F.pmod("key", F.lit(SLICES)) == k
        entries = units.select(keys, "row", "id", "at", "print", *[f"q{k}" for k in range(_packs(percent))]).filter(mine)
        slices.append(scratch.keep(entries.join(across.filter(mine).hint("shuffle_hash"), "key", "left_semi")))
    scratch.drop(units, across)
    met = reduce(DataFrame.unionByName, slices)
    # Equal rows are one document, so a paragraph counts once per row and place.
    own = scratch.keep(met.select("row", "id", "at", "print").distinct())
    nodes, members = _members(met, percent, scratch)
    scratch.drop(*slices)

    wanted = nodes.join(members.select("id").distinct(), "id", "left_semi")
    only = F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("only")
    by_row = wanted.groupBy(F.col("lo").alias("row")).agg(F.collect_list(F.struct("at", only)).alias("wanted"))
    texts = named.select("row", "text").join(by_row.hint("shuffle_hash"), "row").select("text", "wanted")
    sets = scratch.keep(map_batches(texts, _sets, "id long, only long, items array<long>").dropDuplicates(["id"]))
    label = linked_components(members, sets, percent, 1, scratch)

    classed = own.join(label.withColumnRenamed("node", "print").hint("shuffle_hash"), "print", "left").withColumn("component_id", F.coalesce("component", "print"))
    classed = scratch.keep(classed.drop("component", "print"))
    scratch.drop(members, sets, own)
    groups = classed.groupBy("component_id").agg(
        F.count(F.lit(1)).alias("n_copies"), F.min("row").alias("lo"), F.max("row").alias("hi"), F.min(F.struct("id", _high("at").alias("first"))).alias("keep"))
    found = classed.join(groups.filter("lo <> hi").hint("shuffle_hash"), "component_id")
    return found.select(
        F.col("id").alias(id_col), _high("at").alias("first_word"), _low("at").alias("n_words"), "component_id", "n_copies",
        (~(F.col("id").eqNullSafe(F.col("keep.id")) & (_high("at") == F.col("keep.first")))).alias("removed"),
    )
