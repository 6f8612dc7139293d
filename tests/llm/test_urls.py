import re
from collections import Counter, defaultdict

import pytest

from floodmark.llm.urls import DAMPING, LEAST_DISTRUST, OVER_TRUST, ROUNDS, RULES, judge_urls


def parts(url):
    if not url or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return "".join(c.lower() if c.isascii() else c for c in m[1]), m[2]


def rule_for(host, path, rules):
    best = None
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return best


def plain(pages, rules):
    rows, edges, hosts = [], Counter(), defaultdict(list)
    for i, url, html in pages:
        host, path = parts(url)
        found = rule_for(host, path, rules)
        rows.append((i, host, path, found))
        if host:
            hosts[host].append(found[0] if found else None)
            for x in re.findall(r"""\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or "", re.I):
                if x.lower() != host:
                    edges[host, x.lower()] += 1
    for h in {*hosts, *(x for e in edges for x in e)}:
        if h.count(".") >= 2:
            edges[h, h.split(".", 1)[1]] += 1
    nodes = {*hosts, *(x for e in edges for x in e)}
    scores, totals = {}, {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        way = edges if kind == "trust" else Counter({(b, a): n for (a, b), n in edges.items()})
        seed = {h: sum(v == verdict for v in vs) / len(vs) for h, vs in hosts.items()}
        total = sum(seed.values()) or 1
        seed = {h: s / total for h, s in seed.items()}
        out = Counter()
        for (a, _), n in way.items():
            out[a] += n
        rank = dict(seed)
        for _ in range(ROUNDS):
            new = {h: (1 - DAMPING) * seed.get(h, 0) for h in nodes}
            for (a, b), n in way.items():
                new[b] += DAMPING * n / out[a] * rank.get(a, 0)
            rank = new
        scores[kind] = {h: r * len(nodes) for h, r in rank.items()}
        totals[kind] = sum(rank.values()) or 1.0
    out = {}
    for i, host, path, found in rows:
        t, d = scores["trust"].get(host, 0), scores["distrust"].get(host, 0)
        # What decides is the rank in means of all hosts.
        mt, md = round(t / totals["trust"], 9), round(d / totals["distrust"], 9)
        own = "block" if host and md >= LEAST_DISTRUST and md > OVER_TRUST * mt else "allow"
        out[i] = (host, path, found and found[1], found[0] if found else own, t, d)
    return out


def pages():
    link = lambda *hosts: "<p>" + "".join(f'<a href="https://{h}/x?y=1">a</a> <img SRC=//{h}/i>' for h in hosts)
    rows = [
        "http://a.example.net/en/1", "http://a.example.net/de/1", "https://EXAMPLE.com/de/x", "https://example.com/dex", "http://x.org/fr/?q", "http://x.org/fr", "http://net/", "http://net",
        "http://planet/", "ftp://sub.Planet.NET/a#b", None, "", "nothing", "http://", "://h/p", "http://h?://z/", "a://b://c/d", "http://É.org/fr/", "http://friend.info/en", "http://spam.info/x",
    ]
    out = [(i, u, link("spam.net", "bad.net") if u and "spam.info" in u else link("x.org") if u and "friend" in u else None) for i, u in enumerate(rows)]
    out += [(100 + i, f"http://farm{i}.info/", link("bad.net", "spam.info")) for i in range(30)]
    out += [(200 + i, f"http://bad.net/{i}", link(f"farm{i}.info")) for i in range(30)] + [(300, "http://hub.org/fr/1", link(*[f"h{k}.info" for k in range(40)]) * 3)]
    return out


def test_equal_to_plain_graph(spark):
    rows = pages()
    table = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, rank int").repartition(3)
    got = {r.page_id: tuple(r[1:]) for r in judge_urls(table).collect()}
    want = plain(rows, RULES)
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i][:4] == w[:4], i
        assert got[i][4:] == pytest.approx(w[4:], abs=1e-9)
    assert any(w[2] is None and w[3] == "block" for w in want.values())


def test_odd_tables(spark):
    one = spark.createDataFrame([(None, "http://a.net/", "<a href='//b.c/'>"), (1, "http://q.info/", None), (1, "http://q.info/", None)], "page_id long, url string, html string")
    assert sorted(r.verdict for r in judge_urls(one).collect()) == ["allow", "allow", "block"]
    assert judge_urls(one.limit(0)).collect() == []


def test_threshold_is_the_real_mean(spark):
    # No host has links, so all rank that moves on is lost: each seed keeps 0.15 / 2, 0.75 times the number of hosts.
    rows = [(i, f"http://{h}.net/{p}", None) for i, (h, p) in enumerate(["ax", "ay", "bx", "by"])]
    rows += [(10 + i, f"http://clean{i}.net/", None) for i in range(8)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in judge_urls(table, rules=[("block", "a.net/x"), ("block", "b.net/x")]).collect()}
    assert got[1].rule is None and got[1].distrust < LEAST_DISTRUST
    assert {i for i, r in got.items() if r.verdict == "block"} == {0, 1, 2, 3}
