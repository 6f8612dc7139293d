import hashlib
import math
import random
import re
import time
from collections import Counter

from floodmark.llm.secrets import ALLOWED, CLASSES, WINDOW, digest, find_secrets

ASSIGN = re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def plain(text):
    t = text or ""
    base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    more = []
    taken = {i for a, _, e, _ in base for i in range(a, e)}
    for m in re.finditer("[A-Za-z0-9+/_=-]+", t):
        if len(m[0]) < 20 or any(re.search(p, m[0]) for p in ALLOWED):
            continue
        mask = "".join("." if i in taken else t[i] for i in range(*m.span()))
        for part in re.finditer("[^.]{20,}", mask):
            s = part[0]
            least = next(bits for p, bits in CLASSES.items() if re.search(p, s))
            best = max(entropy(s[i : i + WINDOW]) for i in range(len(s) - WINDOW + 1))
            if round(best, 9) >= least:
                more.append((m.start() + part.start(), 3, m.start() + part.end(), "entropy"))
    show = lambda spans: ",".join(f"{k}:{a}:{e}" for a, _, e, k in sorted(spans))
    count = Counter(k for *_, k in base)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(show(base).encode()).hexdigest(), show(base + more)


def test_equal_to_plain_scan(spark):
    rnd = random.Random(3)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    pick = lambda a, n: "".join(rnd.choice(a) for _ in range(n))
    texts = [
        None, "", "é😀 token = \"abc123\" x", "secret=token: abcdef", "PassWord:'hunter22' api_key=1 apikey = 123456", "ſecret = abcdefgh",
        "AKIA" + "A1" * 8, "AKIAAKIA" + "Z" * 12, "AKIA123 AKIA", "0" * 24, "f" * 23 + "g" + "a" * 24, "deadbeef" * 500,
        "123e4567-e89b-12d3-a456-426614174000", "sha256-" + pick(b64, 43), "x" * 30 + "1", "secret" * 20_000,
        " ".join("key " + pick(b64, rnd.randint(15, 70)) for _ in range(150)), pick(b64, 5000), pick("0123456789ABCDEF", 60), "1" * 50_000,
        " ".join(f"token={pick(b64, 8)}" for _ in range(800)), " ".join(pick(b64[:52], 24) for _ in range(40)), " ".join(pick(b64[26:52], 24) for _ in range(40)),
        pick(b64, 30) + "+" + "ab12" * 7 + "Z" + pick(b64, 40) + "/" + "0f" * 13 + "/" + pick(b64, 10), "G" * 19 + "f" * 24 + pick(b64[:26], 30),
        "Donaudampfschifffahrtsgesellschaftskapitaen usr/local/share/documentation/reference NullPointerExceptionHandlerFactory",
        "x_token=" + "ab+/" * 7 + "," + pick(b64, 9) + "AKIA" + "B7" * 9 + "-" + pick(b64, 33),
    ]
    docs = spark.createDataFrame([(i, t, "z", "k") for i, t in enumerate(texts)], "doc_id long, text string, base string, hex string")
    got = {r.doc_id: tuple(r[1:]) for r in digest(find_secrets(docs)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t), (i, (t or "")[:80])
    assert sum("entropy" in g[4] for g in got.values()) >= 3


def test_tables(spark):
    assert digest(find_secrets(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
    rows = spark.createDataFrame([(None, "token=abcdef"), (1, "token=abcdef"), (1, "token=abcdef")], "doc_id long, text string")
    assert [r.n_assign for r in digest(find_secrets(rows)).collect()] == [1, 1, 1]


def test_many_matches_in_one_text(spark):
    """Time grows with the text, not with its square."""
    text = "token=abcdef, " * 100_000 + "q" + "0" * 24 + "/" + "pQ7" * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.perf_counter()
    got = digest(find_secrets(docs)).collect()[0]
    assert (got.n_assign, got.n_hex) == (100_000, 1) and time.perf_counter() - begin < 60
    assert got.base_sha256 == plain(text[: len("token=abcdef, ") * 100_000 + 25])[3]
