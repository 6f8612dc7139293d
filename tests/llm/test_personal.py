import hashlib
import random
import re
import time
from collections import Counter, defaultdict

from floodmark.llm.personal import MIN_CONFIDENCE, MIN_DIGITS, MIN_SEEDS, REACH, ROUNDS, digest, find_personal_data, mask_personal_data

SPACE = "[^\\x20\\x09-\\x0D]"


def base(t):
    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in double) % 10 == 0:
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def plain(rows):
    """The whole bootstrap over lists."""
    graph, loose, found = defaultdict(dict), [], {}
    for i, text in rows:
        t = text or ""
        found[i] = base(t)
        seen = [(a, e, True) for a, _, e, _ in found[i]]
        for m in re.finditer(r"(?<![0-9A-Za-z])[0-9]+(?:[./-][0-9]+)*(?![0-9A-Za-z])", t):
            if len(re.sub("[^0-9]", "", m[0])) >= MIN_DIGITS and not any(a < m.end() and m.start() < e for a, e, _ in seen if _):
                seen.append((m.start(), m.end(), False))
        for a, e, seed in seen:
            left = re.search(rf"({SPACE}+)[\x20\x09-\x0D]*$", t[max(0, a - REACH) : a])
            right = re.match(rf"[\x20\x09-\x0D]*({SPACE}+)", t[e : e + REACH])
            names = [f"before {left[1].lower()}"] if left else []
            names += [f"after {right[1].lower()}"] if right else []
            for p in names:
                inst = t[a:e].lower()
                graph[p][inst] = graph[p].get(inst, False) or seed
            if not seed:
                loose.append((i, a, e, names))
    graph = {p: g for p, g in graph.items() if sum(g.values()) >= MIN_SEEDS}
    score = {(p, x): float(s) for p, g in graph.items() for x, s in g.items()}
    for k in range(ROUNDS):
        sure = {p: sum(score[p, x] for x in g) / (len(g) + 1) for p, g in graph.items()}
        left = defaultdict(lambda: 1.0)
        for p, g in graph.items():
            for x, seed in g.items():
                if not seed:
                    left[x] *= 1 - sure[p]
        score = {(p, x): 1.0 if s else 1 - left[x] for p, g in graph.items() for x, s in g.items()}
    more = defaultdict(set)
    for i, a, e, names in loose:
        if any(sure.get(p, 0) >= MIN_CONFIDENCE for p in names):
            more[i].add((a, 4, e, "context"))
    show = lambda spans: ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(spans))
    out = {}
    for i, spans in found.items():
        n = Counter(k for *_, k in spans)
        out[i] = (n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(show(spans).encode()).hexdigest(), show(spans + sorted(more[i])))
    return out


def texts():
    rnd = random.Random(4)
    rows = []
    for i in range(120):
        number = "".join(rnd.choice("0123456789") for _ in range(9))
        kind = rnd.choice(["reach me at u%d@mail.example.com now", "host 10.0.%d.7 is up", "call +1 (555) 010-%04d today", "reach me at " + number + " now", "total " + number + " units", "host " + number + " is up", "call " + number])
        rows.append("é😀 text " + (kind % i if "%" in kind else kind) + " and more")
    rows += [None, "", "a@b.co%x@c.de _y@z.org.", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.4", "4111 1111 1111 1111-", "+1 (2) 3 4 5 6 7 8 9 0   +", "a" * 30_000 + "@", "1." * 9000, "a@" + "b." * 9000 + "c", "1 " * 9000]
    return list(enumerate(rows))


def test_equal_to_plain_bootstrap(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, base string, pattern int").repartition(3)
    got = {r.doc_id: tuple(r[1:]) for r in digest(find_personal_data(docs)).collect()}
    want = plain(rows)
    for i, _ in rows:
        assert got[i] == want[i], i
    assert sum("context" in g[-1] for g in got.values()) > 5


def test_masking(spark):
    rows = [(1, "call +1 (555) 010-2345 or a@b.co é 10.0.0.1", 5), (1, "call +1 (555) 010-2345 or a@b.co é 10.0.0.1", 5), (2, None, 6), (None, "x a@b.co", 7), (3, "none", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    out = mask_personal_data(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [
        (1, "call <phone> or <email> é <ip>", 5), (1, "call <phone> or <email> é <ip>", 5), (2, None, 6), (None, "x <email>", 7), (3, "none", 8)]))
    assert mask_personal_data(docs.limit(0)).collect() == []
    assert digest(find_personal_data(docs.limit(0))).collect() == []


def test_many_matches_in_one_text(spark):
    """Time grows with the text, not with its square."""
    text = "".join(f"no {i:06d} u{i % 97}@x.org, " for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.perf_counter()
    got = digest(find_personal_data(docs)).collect()[0]
    assert got.n_email == 100_000 and got.base_sha256 == hashlib.sha256(",".join(f"email:{a}:{e}" for a, _, e, _ in base(text)).encode()).hexdigest()
    masked = mask_personal_data(docs).collect()[0].text
    assert masked == re.sub("u[0-9]+@x.org", "<email>", text) and time.perf_counter() - begin < 90


def test_texts_without_numbers_or_addresses_are_not_shuffled(spark):
    docs = spark.createDataFrame(
        [(1, "mail bo@a.org now"), (2, "no such thing"), (None, "no such thing"), (3, None), (1, "mail bo@a.org now"), (None, "to c@d.org"), (4, "")],
        "doc_id long, text string")
    out = mask_personal_data(docs)
    assert sorted(map(str, out.collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "mail <email> now"), (2, "no such thing"), (None, "no such thing"), (3, None), (1, "mail <email> now"), (None, "to <email>"), (4, "")],
        "doc_id long, text string").collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "(size(seen" in plan.split("Join")[0]
