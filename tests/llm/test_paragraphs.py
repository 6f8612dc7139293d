import random
from collections import defaultdict

import numpy as np
from conftest import plan_of

from floodmark.llm.paragraphs import SLICES, WINDOW, _fresh, _last_lowest, _lowest, _paragraphs, paragraph_table, repeated_paragraphs
from floodmark.llm.scratch import Scratch
from floodmark.llm.shingles import shingle_rows, word_hashes


def plain(rows, percent):
    """Components of all paragraphs by comparing all pairs, as {(id, first): (component members)} over two documents."""
    units, sets = [], {}
    for i, text in sorted(set(rows), key=str):
        _, first, size, _, _ = paragraph_table([text])
        h = shingle_rows(word_hashes(text))
        for f, n in zip(first.tolist(), size.tolist()):
            units.append((i, f))
            sets[i, f] = frozenset(h[f : f + n - 4].tolist())
    root = {u: u for u in units}

    def find(u):
        while root[u] != u:
            u = root[u]
        return u

    for k, a in enumerate(units):
        for b in units[k + 1 :]:
            x, y = sets[a], sets[b]
            if x == y or a[0] != b[0] and 100 * len(x & y) >= percent * len(x | y):
                root[find(b)] = find(a)
    groups = defaultdict(set)
    for u in units:
        groups[find(u)].add(u)
    return {frozenset(g) for g in groups.values() if len({i for i, _ in g}) > 1}


def texts():
    rnd = random.Random(9)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    passage, line = prose(52), prose(30)
    near = line.split()
    near[3] = "other"
    rows = [(i, prose(rnd.randint(5, 90)) + " " + passage + " " + prose(rnd.randint(5, 200))) for i in range(12)]
    rows += [(20 + i, prose(70) + "\n" + (line if i % 2 else " ".join(near)) + "\n" + prose(10)) for i in range(8)]
    rows += [(40 + i, prose(300) + "\n" + prose(25)) for i in range(6)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, prose(10)), (54, "w " * 300), (55, "w " * 300)]
    return rows


def test_equal_to_all_pairs(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, key int").repartition(3)
    out = repeated_paragraphs(docs).collect()
    got = defaultdict(set)
    for r in out:
        got[r.component_id].add((r.doc_id, r.first_word))
        assert r.n_copies == sum(x.component_id == r.component_id for x in out)
    want = plain(rows, 80)
    assert set(map(frozenset, got.values())) == want
    for r in out:
        assert r.removed == ((r.doc_id, r.first_word) != min(got[r.component_id]))
    found = {r.doc_id for r in out}
    assert set(range(12)) <= found and set(range(20, 28)) <= found and not found & {*range(40, 46), 50, 51, 52, 53}


def test_every_stretch_of_fifty_words_has_a_window():
    rnd = np.random.default_rng(1)
    passage = [f"p{i}" for i in range(50)]
    for _ in range(60):
        pad = [f"x{k}" for k in rnd.integers(0, 10**6, 120)]
        at = int(rnd.integers(0, 120))
        _, first, size, _, _ = paragraph_table([" ".join(pad[:at] + passage + pad[at:])])
        assert any(at <= f and f + n <= at + 50 for f, n in zip(first.tolist(), size.tolist()))


def test_odd_rows(spark):
    assert repeated_paragraphs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    text = " ".join(f"w{i}" for i in range(30))
    rows = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_copies, r.removed) for r in repeated_paragraphs(rows).collect())
    assert got == [(-1, 2, False), (1, 2, True)]
    assert repeated_paragraphs(rows.filter("doc_id = 1")).collect() == []


def test_windows_cross_line_breaks_without_gaps():
    rnd = random.Random(5)
    for k in range(40):
        passage = [f"{k}p{i}" for i in range(60)]
        found = []
        for width in (7, 13, 30, 55):
            pad = lambda: [f"x{rnd.random()}" for _ in range(rnd.randint(0, 40))]
            head = pad()
            words = head + passage + pad()
            text = "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))
            _, first, size, _, _ = paragraph_table([text])
            units = list(zip(first.tolist(), size.tolist()))
            assert len({f for f, _ in units}) == len(units)
            assert {w for f, n in units for w in range(f, f + n)} == set(range(len(words)))
            found.append({f - len(head) for f, n in units if n == 16 and len(head) <= f and f + n <= len(head) + 60})
        assert all(found[0] & other for other in found[1:])
        covered = {w for f in found[0] for w in range(f, f + 16)}
        assert set(range(15, 45)) <= covered


def test_near_lines_share_a_band():
    rnd = random.Random(6)
    for k in range(400):
        line = [f"{k}w{rnd.random()}" for _ in range(30)]
        near = [*line[:1], "other", *line[2:]]  # 24 of 28 shingles
        a, b = (paragraph_table([" ".join(x)])[4] for x in (line, near))
        assert len(a) == len(b) == 1 and (a[0] == b[0]).any(), k


def test_long_lines_are_compared_whole(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(60):
        line = [f"{i}w{k}" for k in range(rnd.choice([51, 60, 80]))]
        near = list(line)
        near[len(line) // 2] = "other"
        rows += [(2 * i, " ".join(line)), (2 * i + 1, " ".join(near))]
    sizes = {i: len(text.split()) for i, text in rows}
    out = repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    whole = {r.doc_id for r in out if r.n_words == sizes[r.doc_id]}
    assert whole == set(range(120))


def test_linked_windows_have_two_parts_in_common():
    rnd = random.Random(7)
    for percent in (60, 80, 90, 100):
        linked = 0
        words = [f"w{k % 37 if k > 200 else k}" for k in range(400)]
        near = [w if rnd.random() > 0.04 else "other" for w in words]
        texts = [" ".join(words), " ".join(near), " ".join(words[3:])]
        owner, first, size, _, _, parts = _paragraphs(texts, percent)
        rows = [shingle_rows(word_hashes(t)) for t in texts]
        windows = [(frozenset(rows[o][f : f + n - 4].tolist()), p) for o, f, n, p in zip(owner, first, size, parts.tolist()) if n == WINDOW]
        for k, (x, p) in enumerate(windows):
            for y, q in windows[k + 1 :]:
                if 100 * len(x & y) >= percent * len(x | y):
                    linked += 1
                    assert sum(a == b for a, b in zip(p, q)) >= 2
        assert linked


def test_sets_without_order():
    rnd = np.random.default_rng(3)
    for width in (1, 2, 3, 12, 16, 31):
        values = rnd.integers(0, 40, 200).astype(np.uint64)
        spans = [values[i : i + width].tolist() for i in range(len(values) - width + 1)]
        assert _lowest(values, width).tolist() == [min(x) for x in spans]
        assert _last_lowest(values, width).tolist() == [i + max(k for k, v in enumerate(x) if v == min(x)) for i, x in enumerate(spans)]
    assert not len(_lowest(values[:3], 12)) and not len(_last_lowest(values[:0], 12))
    sizes = rnd.integers(1, 60, 30)
    offsets = np.cumsum(sizes) - sizes
    items = rnd.integers(0, 50, sizes.sum()).astype(np.uint64)
    fresh = _fresh(items, offsets)
    for at, n in zip(offsets, sizes):
        assert sorted(items[at : at + n][fresh[at : at + n]]) == sorted(set(items[at : at + n].tolist()))


def test_paragraphs_with_repeated_shingles_are_sets():
    rnd = random.Random(11)
    texts = ["\n".join(" ".join(rnd.choice("abc"[: rnd.choice([1, 2, 3])]) for _ in range(rnd.randint(0, 70))) for _ in range(6)) for _ in range(40)]
    owner, first, size, prints, _, parts = _paragraphs(texts, 80)
    rows = [shingle_rows(word_hashes(t)) for t in texts]
    sets = [frozenset(rows[o][f : f + n - 4].tolist()) for o, f, n in zip(owner, first, size)]
    assert len(set(sets)) == len(set(prints.tolist())) == len(set(zip(sets, prints.tolist())))
    windows = [(x, tuple(p)) for x, p, n in zip(sets, parts.tolist(), size) if n == WINDOW]
    assert len(set(windows)) == len({x for x, _ in windows})
    assert all(p[0] == (80 * len(x) <= 1200) for x, p, n in zip(sets, parts.tolist(), size) if n > WINDOW)


def test_entries_are_not_sorted_and_shared_keys_are_found_once(spark, monkeypatch):
    plans, keep = [], Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df: plans.append(plan_of(df)) or keep(self, df))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        repeated_paragraphs(spark.createDataFrame(texts(), "doc_id long, text string")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    semi = [p for p in plans if "pmod(key" in p]
    assert len(semi) == SLICES and all("ShuffledHashJoin" in p and "SortMergeJoin" not in p for p in semi)
    assert sum("Generate explode" in p and "min(row" in p for p in plans) == 1
