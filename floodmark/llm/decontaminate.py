"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over windows, exact edit verification.

Items too short for enough samples are searched exactly, by parts of which one must stand unchanged."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.shingles import mix, word_hashes
from floodmark.llm.text import column

#: Edits allowed per hundred words of an item.
EDIT_PERCENT = 20
#: Items of fewer words are searched by their parts, which misses none; longer ones by walks.
WALK_WORDS = 25
#: Random walks, steps of each, samples of steps per walk and steps per sample.
WALKS, STEPS, SAMPLES, TAKEN = 2, 10, 1, 4
#: Bytes of item text searched in one pass over the documents; each pass holds them in every task.
BLOCK_BYTES = 8_000_000
_SLOTS = 1 << 22


def _samples(seed: int = 7) -> list[list[np.ndarray]]:
    """For each walk, the sampled steps of each table; the first step is always taken, to fix the place."""
    rng = np.random.default_rng(seed)
    return [
        [np.sort(np.concatenate([[0], 1 + rng.permutation(STEPS - 1)[: TAKEN - 1]])) for _ in range(SAMPLES)]
        for _ in range(WALKS)
    ]


def embedded_keys(words: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """For each table, a 64-bit key of the walk from each start.

    The walk of step j writes the word it stands on and moves on by one word if bit j of that word's random number is
    set; past the end it writes nothing. Edit distance becomes Hamming distance between walks; a key takes the words
    written at the sampled steps, so equal keys are likely where the walks differ in few steps.
    """
    padded = np.concatenate([words, np.zeros(STEPS + 1, dtype=np.uint64)])
    out = []
    for walk, tables in enumerate(_samples()):
        seed = np.uint64(0x9E3779B97F4A7C15 * (walk + 1) & (2**64 - 1))
        move = (mix(padded + seed) & np.uint64((1 << STEPS) - 1)).astype(np.int16)
        at = starts.copy()
        keys = [np.full(len(starts), walk * SAMPLES + t + 1, dtype=np.uint64) for t in range(len(tables))]
        for j in range(max(steps[-1] for steps in tables) + 1):
            for key, steps in zip(keys, tables):
                if j in steps:
                    key *= np.uint64(0x9E3779B97F4A7C15)
                    key += padded[at]
                    key ^= key >> np.uint64(29)
            at += (move[at] >> j) & 1
        out += keys
    return out


def parts(n: int, room: int) -> list[tuple[int, int]]:
    """(offset, words) of room + 1 parts of an item of n words: so many edits leave one of them unchanged."""
    cuts = [n * k // (room + 1) for k in range(room + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:]) if a < b]


def part_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key of the `size` words from each place on that has so many."""
    key = np.full(max(0, len(words) - size + 1), size, dtype=np.uint64)
    for k in range(size):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(key)])
    return key


def edit_match(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the stretch of `window` with the fewest word edits to `item`; ties take the first end,
    then the longest stretch."""
    n = len(window)
    for j in np.flatnonzero(window[: n - len(item) + 1] == item[0]).tolist() if n >= len(item) else ():
        if np.array_equal(window[j : j + len(item)], item):
            return 0, j, j + len(item)
    cost, origin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    for i, word in enumerate(item, 1):
        step = np.empty(n + 1, dtype=np.int64)
        src = np.empty(n + 1, dtype=np.int64)
        step[0], src[0] = i, 0
        swap = cost[:-1] + (window != word)
        drop = cost[1:] + 1
        step[1:] = np.minimum(swap, drop)
        src[1:] = np.where(swap < drop, origin[:-1], np.where(drop < swap, origin[1:], np.minimum(origin[:-1], origin[1:])))
        # An inserted word: the best of all places before, one edit a word.
        level = step - np.arange(n + 1)
        best = np.minimum.accumulate(level)
        first = np.where(level < np.concatenate([[n + i + 1], best[:-1]]), np.arange(n + 1), 0)
        lead = np.maximum.accumulate(first)
        step, src = best + np.arange(n + 1), src[lead]
        cost, origin = step, src
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


class _Block:
    """Items of one pass: word hashes, and for each key the items and offsets that have it."""

    def __init__(self, texts: list[str], percent: int) -> None:
        self.items = [word_hashes(t) for t in texts]
        self.room = [len(w) * percent // 100 for w in self.items]
        self.bags = [Counter(w.tolist()) for w in self.items]
        found = defaultdict(list)
        for i, w in enumerate(self.items):
            if len(w) < WALK_WORDS:
                for offset, size in parts(len(w), self.room[i]):
                    found[int(part_keys(w[offset : offset + size], size)[0])].append((i, offset))
                continue
            starts = np.arange(len(w) - STEPS + 1)
            for keys in embedded_keys(w, starts):
                for offset, key in enumerate(keys.tolist()):
                    found[key].append((i, offset))
        self.found = {key: list(dict.fromkeys(v)) for key, v in found.items()}
        short = [n for n in map(len, self.items) if n < WALK_WORDS]
        self.sizes = sorted({size for n in set(short) for _, size in parts(n, n * percent // 100)})
        self.walks = len(short) < len(self.items)
        self.slots = np.zeros(_SLOTS, dtype=bool)
        self.slots[[k & (_SLOTS - 1) for k in self.found]] = True

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, start, end) of the best match of each item in each text, places in words."""
        each = [word_hashes(t) for t in texts]
        # Texts stand one behind the other, with room between them that no key crosses with a word of both.
        gap = np.zeros(STEPS, dtype=np.uint64)
        words = np.concatenate([x for w in each for x in (w, gap)])
        first = np.cumsum([0, *(len(w) + STEPS for w in each)])[:-1]
        tried: set[tuple[int, int, int]] = set()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        walked = embedded_keys(words, np.arange(len(words))) if self.walks else []
        for keys in [*walked, *(part_keys(words, size) for size in self.sizes)]:
            places = np.flatnonzero(self.slots[(keys & np.uint64(_SLOTS - 1)).astype(np.int64)])
            owners = np.searchsorted(first, places, "right") - 1
            for at, owner, key in zip(places.tolist(), owners.tolist(), keys[places].tolist()):
                for i, offset in self.found.get(key, ()):
                    room, item = self.room[i], self.items[i]
                    # Begins are taken together by room + 1; one wide window holds all matches of such a step.
                    step = (at - offset) // (room + 1)
                    if (owner, i, step) in tried:
                        continue
                    tried.add((owner, i, step))
                    low = max(int(first[owner]), step * (room + 1) - room)
                    high = min(int(first[owner]) + len(each[owner]), step * (room + 1) + len(item) + 2 * room + 1)
                    old = best.get((owner, i), (len(item) + 1, 0, 0))
                    if old[0] == 0 and low - int(first[owner]) >= old[1]:
                        continue  # an exact match stands before all of this window
                    window = words[low:high]
                    held = list(filter(self.bags[i].__contains__, window.tolist()))
                    if len(held) < len(item) - room or (Counter(held) & self.bags[i]).total() < len(item) - room:
                        continue
                    distance, a, b = edit_match(item, window)
                    if distance <= room:
                        place = low - int(first[owner])
                        best[owner, i] = min(old, (distance, place + a, place + b))
        return [(*where, *match) for where, match in sorted(best.items())]


def _searching(texts: list[str], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(texts, percent)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 128):
                names, bodies = (c.to_pylist() for c in batch.slice(at, 128).columns)
                rows += [(names[d], texts[i], *match) for d, i, *match in block.search(bodies)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [batch.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "text", "distance", "start_word", "end_word"]
            )

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", percent: int = EDIT_PERCENT,
) -> DataFrame:
    """One row per document and benchmark item found in it: id, item id, distance, start_word, end_word (exclusive).

    An item of n words (A-Z lower-cased, ASCII white space) is found if some stretch of the document is within
    floor(n * percent / 100) word edits of it; the row has the closest stretch, the first of ties. Of items under 25 words
    none is missed: a part of them stands unchanged in every match; under 5 words the whole item does. Null or blank
    items are not searched; items of equal words each give their rows. Null or blank documents, and
    empty tables, give none. Documents with a null id keep it; repeated rows each give rows. Other columns are ignored.

    The benchmark is the stated query set: it is searched in blocks of at most 8 MB of distinct item text, each held in
    every task, and one pass over the documents per block. Documents are not shuffled; each is searched as a whole.
    """
    items = benchmark.select(column(item_col).alias("item"), column(item_text_col).alias("text")).filter("text is not null")
    texts = items.select("text").distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-2 * size // BLOCK_BYTES))
    narrow = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    found = None
    for k in range(blocks):
        rows = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).collect()
        block = sorted(r.text for r in rows if len(word_hashes(r.text)))
        if block or found is None and k == blocks - 1:
            one = map_batches(narrow, 
                _searching(block, percent), f"id {kind}, text string, distance long, start_word long, end_word long"
            )
            found = one if found is None else found.unionByName(one)
    return found.join(items, "text").select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "distance", "start_word", "end_word"
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` in which no benchmark item is found, unchanged; rows are told apart by id and text."""
    key = F.struct(column(id_col).alias("i"), F.xxhash64(column(text_col)).alias("h"))
    found = contamination(docs.select(key.alias("key"), column(text_col).alias("text")), benchmark, "key", "text")
    found = found.select(F.col("key.i").alias("_found_id"), F.col("key.h").alias("_found_hash")).distinct()
    same = column(id_col).eqNullSafe(F.col("_found_id")) & (F.xxhash64(column(text_col)) == F.col("_found_hash"))
    return docs.join(found, same, "left_anti")
