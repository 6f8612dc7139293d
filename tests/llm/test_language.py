import math
import random
import zlib
from collections import Counter

import numpy as np

from floodmark.llm.language import BITS, BUCKETS, CLOSE, codewords, fit, identify, ngram_counts

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in identify(docs).collect()}
    true = {r.doc_id: r.lang for r in docs.collect()}
    assert set(rows) == set(true)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [i for i, r in rows.items() if r.held_out]
    assert len(held) > 20 and np.mean([rows[i].lang_pred == true[i] for i in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_counts_do_not_cross_texts():
    texts = ["abc", None, "", "é x", "abc"]
    both = ngram_counts(texts)
    assert both.shape == (5, BUCKETS)
    for k, t in enumerate(texts):
        assert (both[k] == ngram_counts([t])[0]).all()
    assert (both[0] == both[4]).all() and both[1].sum() == both[2].sum() == 0


def test_codewords_differ():
    for n in (1, 2, 4, 40, 300):
        words = codewords(n)
        assert len({tuple(w) for w in words}) == n
    assert min((a != b).sum() for i, a in enumerate(codewords(4)) for b in codewords(4)[:i]) >= 7


def test_odd_rows(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, "das ist ein haus und ein garten" if i % 2 else "the house and the garden of them", "de" if i % 2 else "en", 0.5) for i in ids]
    rows += [(1000, None, "de", 0.0), (1001, "123 !", "en", 0.0), (1002, "", None, 0.0), (None, "the garden", "xx", 0.0), (1003, "ein haus " * 20_000, None, 0.0), (1003, "ein haus", None, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = [(r.doc_id, r.lang_pred) for r in identify(docs).collect()]
    assert len(got) == len(rows)
    assert {(1000, "und"), (1001, "und"), (1002, "und"), (None, "en"), (1003, "de")} <= set(got)
    assert fit(docs).languages == ["de", "en"]
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r.lang_pred for r in identify(unlabelled).collect()} == {"und"}
    assert identify(docs.limit(0)).collect() == []


def plain_counts(text):
    """Buckets of a text's byte pairs and triples, one by one."""
    found = Counter()
    data = (" " + text.lower() + " ").encode() if text else b""
    for n in (2, 3):
        for at in range(len(data) - n + 1):
            h = n
            for byte in data[at : at + n]:
                h = (h ^ byte) * 0x01000193 % 2**32
            found[(h * 0x9E3779B1 % 2**32) >> (32 - int(math.log2(BUCKETS)))] += 1
    return found


def plain_predictions(rows):
    """(lang_pred, score, ambiguous) of each row (id, text, lang), fitted and decoded number by number."""
    sums = {}
    for i, text, lang in rows:
        if None not in (i, text, lang) and zlib.crc32(str(i).encode()) % 4 != 2:
            sums.setdefault(lang, Counter()).update(plain_counts(text))
    langs = sorted(sums)
    codes = codewords(len(langs))
    share = []
    for lang in langs:
        whole = sum(sums[lang].values()) + 0.5 * BUCKETS
        share.append([(sums[lang][b] + 0.5) / whole for b in range(BUCKETS)])
    weights, trust = [], []
    for bit in range(codes.shape[1]):
        one = [k for k in range(len(langs)) if codes[k][bit] > 0]
        zero = [k for k in range(len(langs)) if codes[k][bit] < 0]
        if not one or not zero:
            weights.append([0.0] * BUCKETS)
        else:
            weights.append([math.log(sum(share[k][b] for k in one) / len(one) + 1e-12) - math.log(sum(share[k][b] for k in zero) / len(zero) + 1e-12) for b in range(BUCKETS)])
        trust.append(max(0.0, min(codes[k][bit] * sum(s * w for s, w in zip(share[k], weights[-1])) for k in range(len(langs)))))
    trust = [t / max(trust) for t in trust]
    out = []
    for _, text, _ in rows:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0, True))
            continue
        counts = plain_counts(text)
        length = math.sqrt(sum(counts.values()))
        margin = [sum(n * w[b] for b, n in counts.items()) / length for w in weights]
        loss = [sum(t * math.log1p(math.exp(-m * c)) for m, c, t in zip(margin, codes[k], trust)) for k in range(len(langs))]
        best = min(loss)
        second = min([x for k, x in enumerate(loss) if k != loss.index(best)], default=best + 2 * CLOSE)
        out.append((langs[loss.index(best)], 1 / sum(math.exp(best - x) for x in loss), second - best < CLOSE))
    return out


def test_equal_to_plain_fit_and_decoding(spark):
    rnd = random.Random(8)
    sounds = {"aa": "ab la ma no", "bb": "ber tur gan ab", "cc": "xi qo zu ma", "dd": "éa ñu ab la", "ee": "tur no zu la"}
    rows = []
    for i in range(160):
        lang = rnd.choice(list(sounds))
        mixed = sounds[lang].split() + (sounds[rnd.choice(list(sounds))].split() if i % 5 == 0 else [])
        text = " ".join("".join(rnd.choices(mixed, k=rnd.randint(1, 3))) for _ in range(rnd.randint(1, 25)))
        rows.append((i, text.title() if i % 7 == 0 else text, None if i % 11 == 0 else lang))
    rows += [(500, None, "aa"), (501, "12 34", None), (502, "", "bb"), (503, "la", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in identify(docs).collect()}
    assert codewords(5).shape[1] >= BITS
    kinds = set()
    for (i, _, _), (lang, score, close) in zip(rows, plain_predictions(rows)):
        r = got[i]
        assert (r.lang_pred, r.ambiguous) == (lang, close) and abs(r.score - score) < 1e-4
        kinds.add((lang, close))
    assert len(kinds) > 5
