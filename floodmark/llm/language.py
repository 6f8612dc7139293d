"""Language identification by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.text import column

#: Buckets of hashed byte n-grams (2 and 3 bytes of the lower-cased text), and bits of a codeword.
BUCKETS, BITS = 1 << 13, 15
#: A text is ambiguous if the second-nearest codeword's loss is within this share of a bit of the nearest one's.
CLOSE = 0.5
UNKNOWN = "und"


def held_out(name: Column) -> Column:
    """Whether a row is kept from learning: CRC-32 of the id as text, modulo 4, is 2. Null ids are neither."""
    return F.coalesce(F.crc32(name.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def ngram_counts(texts: list[str | None]) -> np.ndarray:
    """One row of bucket counts per text."""
    data = [np.frombuffer((" " + t.lower() + " ").encode(), dtype=np.uint8) if t else np.empty(0, np.uint8) for t in texts]
    sizes = np.array([len(d) for d in data])
    owner = np.repeat(np.arange(len(data), dtype=np.int64), sizes) * BUCKETS
    b = np.concatenate(data).astype(np.uint32) if data else np.empty(0, np.uint32)
    total = np.zeros(len(data) * BUCKETS, dtype=np.int64)
    for n in (2, 3):
        if len(b) < n:
            continue
        h = np.full(len(b) - n + 1, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ b[k : len(b) - n + 1 + k]) * np.uint32(0x01000193)
        bucket = ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
        # An n-gram belongs to the text of its first byte, if its last byte is of the same text.
        inside = owner[: len(h)] == owner[n - 1 :]
        total += np.bincount((owner[: len(h)] + bucket)[inside], minlength=len(total))
    return total.reshape(len(data), BUCKETS)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts per language of the rows (lang, text) of a task."""
    sums: dict[str, np.ndarray] = {}

    def rows():
        for lang, counts in sorted(sums.items()):
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                ["lang", "bucket", "n"],
            )
        sums.clear()

    for batch in batches:
        langs, texts = (c.to_pylist() for c in batch.columns)
        for at in range(0, len(texts), 128):
            counts = ngram_counts(texts[at : at + 128])
            part = np.array(langs[at : at + 128], dtype=object)
            for lang in set(part):
                sums[lang] = sums.get(lang, 0) + counts[part == lang].sum(axis=0)
        if len(sums) > 200:
            yield from rows()
    yield from rows()


def codewords(n: int, bits: int = BITS, seed: int = 11) -> np.ndarray:
    """n different codewords of +1 and -1, chosen one by one to be far from those before and to split them evenly."""
    rng = np.random.default_rng(seed)
    bits = max(bits, 4 * max(n - 1, 1).bit_length())
    words = np.empty((0, bits))
    while len(words) < n:
        tried = rng.choice([-1.0, 1.0], size=(512, bits))
        if len(words):
            apart = ((tried[:, None, :] != words[None, -256:, :]).sum(axis=2)).min(axis=1)
            uneven = np.abs(tried + words.sum(axis=0)).sum(axis=1)
            tried = tried[np.lexsort((uneven, -apart))]
            if apart.max() == 0:
                continue
        words = np.vstack([words, tried[:1]])
    return words


@dataclass
class Model:
    """Weights (buckets x bits) of the bits' classifiers, the languages' codewords, and the weight of each bit's loss."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) per text: the codeword of least weighted logistic loss."""
        counts = ngram_counts(texts).astype(np.float32)
        # A margin is the summed log odds, damped by the root of the length: n-grams of a text are not independent.
        margin = (counts @ self.weights).astype(np.float64) / np.sqrt(np.maximum(counts.sum(axis=1, keepdims=True), 1.0))
        loss = (np.logaddexp(0, -margin[:, None, :] * self.codes[None]) * self.trust).sum(axis=2)
        order = np.argsort(loss, axis=1, kind="stable")
        best = np.take_along_axis(loss, order[:, :1], 1)
        score = 1.0 / np.exp(np.minimum(best - loss, 0.0)).sum(axis=1)
        second = np.take_along_axis(loss, order[:, 1:2], 1) if loss.shape[1] > 1 else best + 2 * CLOSE
        return [self.languages[i] for i in order[:, 0]], score, (second - best)[:, 0] < CLOSE


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of the labelled rows that are not held out: all of them, whole, none sampled; None without any.

    Tasks sum n-gram counts per language, so what comes to the driver is one table of 2^13 counts per language.
    A bit's classifier has as weights the log odds of each bucket between the languages with that bit and those without,
    every language counting the same; a bit's loss counts by how well its classifier parts the languages' mean texts.
    """
    known = column(lang_col).isNotNull() & column(text_col).isNotNull() & column(id_col).isNotNull()
    rows = docs.filter(known & ~held_out(column(id_col))).select(column(lang_col).cast("string").alias("lang"), column(text_col).alias("text"))
    counted = map_batches(rows, _summed, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    if not languages:
        return None
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    at = np.array([place[x] for x in found.column("lang").to_pylist()])
    counts[at, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    one, zero = (codes > 0).astype(float), (codes < 0).astype(float)
    mean = lambda side: (side.T @ share) / np.maximum(side.sum(axis=0), 1)[:, None]
    weights = np.log(mean(one) + 1e-12).T - np.log(mean(zero) + 1e-12).T
    # A bit that all languages share says nothing.
    mixed = (one.sum(axis=0) > 0) & (zero.sum(axis=0) > 0)
    weights[:, ~mixed] = 0
    parted = ((share @ weights) * codes).min(axis=0).clip(min=0)
    trust = parted / parted.max() if parted.max() > 0 else np.ones(len(parted))
    return Model(languages, codes, weights.astype(np.float32), trust)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """One row per row of `docs`: id, held_out, lang_pred, score, ambiguous.

    The model is fitted on the labelled rows of `docs` that are not held out (see fit), and predicts every text whole.
    score is the nearest codeword's share in the likelihood of all; ambiguous is set where the second is close. A null
    text or one without a letter gives `und`, score 0; so does everything if no row is labelled. Null ids are predicted,
    neither held out nor learned from; repeated rows and other columns change nothing. An empty table gives none.
    """
    model = fit(docs, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                named, score, close = model.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3), pa.array(named), pa.array(score), pa.array(close)],
                    ["id", "held_out", "lettered", "lang_pred", "score", "ambiguous"],
                )

    text = column(text_col)
    narrow = docs.select(
        column(id_col).alias("id"), text.alias("text"), held_out(column(id_col)).alias("held_out"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    if model is None:
        return narrow.select(
            F.col("id").alias(id_col), "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    kind = narrow.schema["id"].dataType.simpleString()
    out = map_batches(narrow, run, f"id {kind}, held_out boolean, lettered boolean, lang_pred string, score double, ambiguous boolean")
    some = F.col("lettered")
    return out.select(
        F.col("id").alias(id_col), "held_out", F.when(some, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(some, F.col("score")).otherwise(0.0).alias("score"), (F.col("ambiguous") | ~some).alias("ambiguous"),
    )
