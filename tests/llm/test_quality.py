import re
from collections import Counter, defaultdict

from floodmark.llm.quality import good_documents, quality_rules


def plain(rows, limit=0.8):
    measured, hosts = [], defaultdict(list)
    for i, text, host in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        count = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        covered = {k + d for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        measured.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed, host))
        hosts[host].append(failed)
    raw = {h: sum(f) / len(f) for h, f in hosts.items()}
    m = sum(raw.values()) / len(raw)
    v = sum((x - m) ** 2 for x in raw.values()) / len(raw)
    s = max(1.0, min(1000.0, m * (1 - m) / v - 1 if v else 1000.0))
    rate = {h: (sum(f) + m * s) / (len(f) + s) for h, f in hosts.items()}
    return [(*r[:7], not r[6] and rate[r[7]] <= limit) for r in measured]


def rows():
    word = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    out = [(i, word(i, 60 + i), "good") for i in range(30)]
    out += [(100 + i, "short text", "bad") for i in range(40)] + [(150, word(150, 70), "bad")]
    out += [(200, ("a b c\n" * 40).strip(), None), (201, None, None), (202, "", "good"), (203, " \t\n", "good"), (204, "# | <é> 😀 " * 20, "x")]
    out += [(205, word(1, 30) + "\n" + word(1, 30) + "\n\n\r\n" + word(1, 30), "x"), (206, word(9, 20_000) + " " + word(9, 4000), "x")]
    out += [(207, "a " * 5000, "x"), (None, word(3, 55), "good"), (208, word(4, 55), "good"), (208, word(4, 55), "good")]
    return out


def test_equal_to_plain_rules(spark):
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows()], "doc_id long, text string, source string, n_words int, host string").repartition(4)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in quality_rules(docs).collect()]
    want = plain(rows())
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert (150, False) in {(g[0], g[-1]) for g in got} and (5, True) in {(g[0], g[-1]) for g in got}
    kept = good_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(w[0]) for w in want if w[-1])
    assert quality_rules(docs.limit(0)).collect() == [] and good_documents(docs.limit(0)).collect() == []
