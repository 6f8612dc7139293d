"""Byte-level BPE by the ranks of a public vocabulary: encoding with offsets, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models

from floodmark.llm.batches import map_batches
from floodmark.llm.text import column

#: Distinct pieces a worker remembers, and the longest it keeps.
REMEMBERED, LONGEST = 100_000, 64


def byte_table() -> list[str]:
    """A printable character for each byte: itself if printable, else the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


_TABLE = byte_table()
_BACK = {c: b for b, c in enumerate(_TABLE)}


def to_characters(data: bytes) -> str:
    return data.decode("latin-1").translate(_TABLE)


def to_bytes(characters: str) -> bytes:
    return bytes(map(_BACK.__getitem__, characters))


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def merges(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """The merge behind each token: what its bytes become under all lower ranks, which is two parts."""
    out = []
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            order = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            at = min(range(len(order)), key=order.__getitem__)
            if order[at] >= rank:
                raise ValueError(f"token {rank} is no merge of two tokens of lower rank")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out.append((to_characters(parts[0]), to_characters(parts[1])))
    return out


class Codec:
    """The vocabulary in one worker."""

    def __init__(self, data: bytes, pattern: str) -> None:
        ranks = read_ranks(data)
        vocab = {to_characters(token): rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges(ranks)))
        # The Unicode property; Python's own white space has four separators more.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.token = {rank: to_bytes(characters) for characters, rank in vocab.items()}
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        coded = self.tokenizer.encode_batch_fast([to_characters(p.encode()) for p in pieces], add_special_tokens=False)
        found = {p: np.array(e.ids, dtype="<u4").tobytes() for p, e in zip(pieces, coded)}
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [self.split(t) if t else [] for t in texts]
        new = self._learn([*{p for pieces in split for p in pieces if p not in self.known}])
        known = self.known
        return [b"".join([known[p] if p in known else new[p] for p in pieces]) for pieces in split]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))

    def starts(self, text: str, ids: np.ndarray) -> np.ndarray:
        """For each token, the place of the character that its first byte belongs to."""
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        sizes = np.array([len(self.token[i]) for i in ids.tolist()], dtype=np.int64)
        return character[np.cumsum(sizes) - sizes]


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(shared, pattern: str) -> Codec:
    """This worker's codec, built once for a vocabulary."""
    data = shared.value
    key = (hash(data), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(data, pattern)
    return _codecs[key]


def _vocabulary(df: DataFrame, path: str):
    """The vocabulary file, read where the driver is and sent to the tasks once (a file of about one MB)."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", arrays: bool = True
) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, ids_sha256, decoded_sha256, and with `arrays` also ids and starts
    (array<int>).

    `path` is a file of ranks, `pattern` what splits text before the merges; no special tokens. `starts` has the place of
    the character in which each token begins, so tokens that share a character have the same. The ids are decoded
    again and their bytes hashed beside the ids (little-endian, 32 bits). Null text counts as empty and has no token.
    Null and repeated ids and other columns don't matter; an empty table gives no row. Texts are whole, in one pass.
    """
    shared = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(1).to_pylist()
                coded = codec.encode(texts)
                ids = [np.frombuffer(c, dtype="<u4") for c in coded]
                columns = {
                    "id": part.column(0),
                    "n_tokens": pa.array(map(len, ids), pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                    "decoded_sha256": pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids]),
                }
                if arrays:
                    starts = [codec.starts(t or "", i) for t, i in zip(texts, ids)]
                    columns["ids"] = pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))
                    columns["starts"] = pa.array([x.astype(np.int32) for x in starts], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    narrow = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    out = map_batches(narrow, run, schema + (", ids array<int>, starts array<int>" if arrays else ""))
    return out.withColumnRenamed("id", id_col)


def decode(coded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of `coded`: id, data (the bytes), text. Bytes that are no whole character become U+FFFD in text;
    characters split between tokens come together again, as bytes are joined first. Null ids of tokens give null."""
    shared = _vocabulary(coded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        for batch in batches:
            data = [None if i is None else codec.decode(np.array(i, dtype=np.int64)) for i in batch.column(1).to_pylist()]
            text = [None if d is None else d.decode("utf-8", "replace") for d in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary()), pa.array(text, pa.string())], ["id", "data", "text"])

    narrow = coded.select(column(id_col).alias("id"), column(ids_col).alias("ids"))
    kind = narrow.schema["id"].dataType.simpleString()
    return map_batches(narrow, run, f"id {kind}, data binary, text string").withColumnRenamed("id", id_col)
