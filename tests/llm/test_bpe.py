import hashlib

import numpy as np
import public_tokenizers
import tiktoken

from floodmark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encoder():
    with open(PATH, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "Hello  world\n\n  it's 12345 \t x", "é😀 ñandú — 漢字かな", "a" * 3000, "\x1c\x1d \x85\u2028\u3000x", "<|endoftext|>", "!?" * 500, "   " * 400 + "z", "e\u0301 \ufffd \u200b"]


def test_ids_equal_the_reference_library_and_round_trip(spark):
    enc = encoder()
    rows = [(i, t, "n") for i, t in enumerate(TEXTS)] + [(None, "twice", "n"), (0, "twice", "n"), (0, "twice", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    out = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    by_id = {r.doc_id: r for r in out.filter("doc_id > 0").collect()}
    for i, t in enumerate(TEXTS[1:], 1):
        want, r = enc.encode_ordinary(t or ""), by_id[i]
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        ends, data = 0, (t or "").encode()
        for token, start in zip(want, r.starts):
            assert start == len(data[:ends].decode("utf-8", "ignore"))
            ends += len(enc.decode_single_token_bytes(token))
    assert out.filter("doc_id is null").count() == 1 and out.filter("doc_id = 0").count() == 3
    slim = bpe.encode(docs, PATH, public_tokenizers.PATTERN, arrays=False)
    assert slim.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    back = {r.doc_id: r for r in bpe.decode(out.filter("doc_id > 0"), PATH, public_tokenizers.PATTERN).collect()}
    assert all(back[i].text == (t or "") and bytes(back[i].data) == (t or "").encode() for i, t in enumerate(TEXTS) if i)
    assert bpe.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_part_of_a_character(spark):
    enc = encoder()
    ids = next(x for x in (enc.encode_ordinary(c) for c in "😀🜁𝔘") if len(x) > 1)
    coded = spark.createDataFrame([(1, ids[:1]), (2, ids), (3, None)], "doc_id long, ids array<int>")
    text = {r.doc_id: r.text for r in bpe.decode(coded, PATH, public_tokenizers.PATTERN).collect()}
    assert "\ufffd" in text[1] and "\ufffd" not in text[2] and text[3] is None


def test_every_character_splits_alike():
    with open(PATH, "rb") as f:
        codec = bpe.Codec(f.read(), public_tokenizers.PATTERN)
    enc = encoder()
    texts = [f"a{chr(c)}b{chr(c)} 1" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == [enc.encode_ordinary(t) for t in texts]
