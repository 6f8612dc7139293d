import random

import numpy as np

from floodmark.llm import decontaminate
from floodmark.llm.decontaminate import clean_documents, contamination, edit_match


def edits(item, words):
    """Fewest word edits between the item and any stretch of the words."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_match_is_exact():
    rng = np.random.default_rng(0)
    for _ in range(500):
        a = rng.integers(0, 4, rng.integers(1, 9)).astype(np.uint64)
        b = rng.integers(0, 4, rng.integers(0, 14)).astype(np.uint64)
        distance, start, end = edit_match(a, b)
        assert distance == edits(a.tolist(), b.tolist())
        inside = b[start:end].tolist()
        row = list(range(len(inside) + 1))
        for i, x in enumerate(a.tolist(), 1):
            new = [i]
            for j, y in enumerate(inside, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        assert row[-1] == distance


def tables(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghijk") for _ in range(4))
    items = [[word() for _ in range(rnd.randint(8, 60))] for _ in range(40)] + [["too", "short"], []]
    docs = []
    for i in range(160):
        body = [word() for _ in range(rnd.randint(0, 200))]
        if i % 2:
            item = list(rnd.choice(items[:40]))
            for _ in range(rnd.randint(0, len(item) * 20 // 100 + 1)):
                at = rnd.randrange(len(item))
                item[at : at + 1] = rnd.choice([[], [word()], [item[at], word()]])
            at = rnd.randrange(len(body) + 1)
            body[at:at] = [w.upper() for w in item] if i % 3 else item
        docs.append((i, " ".join(body), i))
    docs += [(200, None, 0), (201, "", 0), (202, " ".join(items[0] * 300), 0), (203, " ".join(items[1]), 0), (203, " ".join(items[1]), 0), (None, " ".join(items[2]), 0)]
    bench = [(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, " ".join(items[3]))]
    return spark.createDataFrame(docs, "doc_id long, text string, item_id int").repartition(4), spark.createDataFrame(bench, "item_id long, text string"), docs, bench


def test_equal_to_brute_force(spark, monkeypatch):
    docs, bench, rows, items = tables(spark)
    want = set()
    for d, text, _ in rows:
        words = (text or "").lower().split()
        for i, item in items:
            item = (item or "").lower().split()
            if item and (n := edits(item, words)) <= len(item) * 20 // 100:
                want.add((d, i, n))
    found = contamination(docs, bench).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in found} == want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)  # several passes
    assert {(r.doc_id, r.item_id, r.distance) for r in contamination(docs, bench).collect()} == want
    hit = {d for d, *_ in want}
    clean = clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, *_ in rows if d not in hit)


def test_empty_tables(spark):
    docs, bench, *_ = tables(spark)
    assert contamination(docs.limit(0), bench).collect() == []
    assert contamination(docs, bench.limit(0)).collect() == []
    assert clean_documents(docs, bench.limit(0)).count() == docs.count()


def test_short_items_are_found_at_the_full_allowance():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(5))
    for n in range(8, 30):
        items = [[word() for _ in range(n)] for _ in range(60)]
        docs = []
        for k, item in enumerate(items):
            at = {0} | set(rnd.sample(range(1, n), n // 5 - 1)) if k % 2 else set(rnd.sample(range(n), n // 5))
            edited = [[w] if i not in at else rnd.choice([[], [word()], [w, word()]]) for i, w in enumerate(item)]
            docs.append(" ".join([word() for _ in range(k % 7)] + sum(edited, []) + [word() for _ in range(k % 5)]))
        block = decontaminate._Block([" ".join(item) for item in items], 20)
        found = {(d, i) for d, i, *_ in block.search(docs)}
        missed = sum((k, k) not in found for k in range(60))
        assert missed == 0 if n < 25 else missed <= 1, n


def test_items_under_eight_words(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 8)]
    docs = [(n, f"x y {text.upper()} z") for n, text in items]
    docs += [(10 + n, "a b " + text.replace(f"i{n}w0", "other", 1) + " c") for n, text in items]
    docs += [(20 + n, " ".join(text.split()[::-1])) for n, text in items if n > 1]
    found = contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(n, n, 0, 2, 2 + n) for n in range(1, 8)}
    assert {tuple(r) for r in found if r.distance == 0} == want
    assert {(r.doc_id, r.item_id, r.distance) for r in found if r.distance} == {(10 + n, n, 1) for n in (5, 6, 7)}
