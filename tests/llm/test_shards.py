import hashlib
from collections import defaultdict

from floodmark.llm.shards import assign_shards


def plain(rows, limit):
    """Splits buckets on one bit after another, by recursion."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    items = defaultdict(list)
    for key, text in rows:
        h = int(md5(("" if key is None else str(key)) + ":" + md5(text or ""))[:15], 16)
        items[h].append((key, len((text or "").encode())))
    out = []

    def split(hashes, depth):
        total = sum(n for h in hashes for _, n in items[h])
        if total > limit and len(hashes) > 1 and depth < 60:
            for bit in (0, 1):
                part = [h for h in hashes if h >> (59 - depth) & 1 == bit]
                if part:
                    split(part, depth + 1)
            return
        for h in hashes:
            for i, (key, n) in enumerate(items[h]):
                room = max(1, limit // max(n, 1))
                out.append((key, n, format(h, "060b")[:depth], depth, i // room if total > limit else 0, total))

    if items:
        split(list(items), 0)
    return out


def test_equal_to_recursion(spark):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(700)] + [(900, "y" * 5000), (901, None), (902, ""), (None, "zz")]
    rows += [(903, "é" * 100)] * 40 + [(904, "ä")] * 3 + [(None, None)] * 2
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, h int, copies int").repartition(3)
    for limit in (1, 3000, 10**9):
        got = [tuple(r) for r in assign_shards(docs, limit=limit).collect()]
        assert sorted(map(str, got)) == sorted(map(str, plain(rows, limit)))
    sizes = defaultdict(int)
    for key, n, shard, _, part, total in assign_shards(docs, limit=3000).collect():
        sizes[shard, part] += n
    assert all(n <= 3000 or n == 5000 for n in sizes.values())


def test_empty(spark):
    assert assign_shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []
