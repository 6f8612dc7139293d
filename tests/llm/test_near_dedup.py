import random
from collections import defaultdict

import pytest

from floodmark.llm.near_dedup import distinct_documents, near_duplicates


def plain(rows, percent=85):
    """Components by comparing all pairs of texts."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(4))
    rows = []
    for group in range(6):
        base = [word() for _ in range(120)]
        for _ in range(40):  # copies from almost equal to hardly alike, so that chains and outsiders occur
            copy = [word() if rnd.random() < rnd.choice([0, 0.005, 0.015, 0.03]) else w for w in base]
            rows.append(" ".join(copy))
    rows += ["", " \n\t", None, "one two", "One TWO", "one two three four five six", "É one two three four", "é one two three four"]
    rows += [" ".join(word() for _ in range(30_000))] * 2
    order = list(range(len(rows)))
    rnd.shuffle(order)
    return [(i, rows[k]) for i, k in enumerate(order)]


def test_components_equal_all_pairs(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, id string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect()}
    want = plain(rows)
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}
    groups = defaultdict(list)
    for i, (_, c) in want.items():
        groups[c].append(i)
    assert max(map(len, groups.values())) > 20 and sum(len(g) == 1 for g in groups.values()) > 20


def test_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(none).collect() == []
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (5, "x y z"), (5, "a b c d e f"), (7, None), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' as print", "1 as n", "2 as component")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in near_duplicates(docs).collect())
    assert got == sorted([
        (1, 2, 1, True), (1, 2, 1, True), (-1, 2, -1, True), (2, 2, 1, False), (5, 1, 5, True), (5, 2, 1, False),
        (7, 0, 7, True), (7, 0, 7, True),
    ])
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "a b c d e f"), (1, "a b c d e f"), (5, "x y z"), (7, "")]


@pytest.mark.parametrize("percent", [80, 95])
def test_other_thresholds(spark, percent):
    rows = texts()[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, percent=percent).collect()}
    assert got == plain(rows, percent)
