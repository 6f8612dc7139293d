import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from floodmark.llm import prefix_trie
from floodmark.llm.queries import LLM_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SMALL = "/root/testdata/sf0.001"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain_sequences(rows):
    """Turns of each conversation in order, from rows (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, (role or "").encode(), digest(role or "", text or ""), role or "", text or ""))
    return {c: [x[4:] for x in sorted(some)] for c, some in turns.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(sequences):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, some in members.items():
        words = len([w for w in re.split(r"[\x20\x09-\x0D]+", node[-1][1]) if w]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(some) - 1) * words
            leaves[node[:d]] += not children[node]
    return sorted(
        (min(some), len(node), min(members[node[:-1]]) if node else None, len(some), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, some in members.items())


def result(df):
    return sorted(tuple(r) for r in df.collect())


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def made(seed, n, kinds=3, longest=6):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * n), n):
        for t in range(r.randint(1, longest)):
            rows.append((c, t, r.choice(["user", "bot"]), "w " * r.randint(0, kinds)))
    return rows


@pytest.mark.parametrize("block", [1, 2, 7, 10_000])
def test_any_cut_into_blocks_gives_the_trie(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", block)
    rows = made(block, 120)
    sequences = plain_sequences(rows)
    records = prefix_trie.turn_records(spark.createDataFrame(rows, SCHEMA).repartition(4))
    keys, ids = [], []
    for key, c in sorted((b"".join(bytes.fromhex(x) for x in r.records), r.conv_id) for r in records.collect()):
        keys.append(key)
        ids.append(c)
    assert len(keys) == len(sequences)
    out = prefix_trie.prefix_trie(records)
    assert out.columns == NAMES and [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert result(out) == plain_trie(sequences)


@pytest.mark.parametrize("seed", range(30))
def test_forest_of_one_block(seed):
    r = random.Random(seed)
    records = [hashlib.sha256(bytes([i])).digest()[:16] + bytes([0, 0, 0, i]) for i in range(3)]
    rows = sorted((b"".join(r.choices(records, k=r.randint(0, 5))), i) for i in range(r.randint(1, 40)))
    forest = prefix_trie.Forest([k for k, _ in rows], [i for _, i in rows])
    prefixes = {k[:at] for k, _ in rows for at in range(0, len(k) + 1, 20)}
    emitted = list(forest.emit(5))
    names = [x[11] for x in emitted if x[0] == prefix_trie.PATH]
    assert len([x for x in emitted if x[0] != prefix_trie.PATH]) + len(set(names)) == len(prefixes)
    assert len(set(names)) == len({k[:at] for k in (rows[0][0], rows[-1][0]) for at in range(0, len(k) + 1, 20)})


def test_common_records():
    r = random.Random(1)
    for _ in range(300):
        a = [bytes(r.choices(b"ab", k=1)) * 20 for _ in range(r.randint(0, 9))]
        n = r.randint(0, 40)
        x, y = b"".join([b"c" * 20] * n + a), b"".join([b"c" * 20] * n + a[: r.randint(0, len(a))] + [b"d" * 20] * r.randint(0, 3))
        want = 0
        while want < min(len(x), len(y)) // 20 and x[20 * want : 20 * want + 20] == y[20 * want : 20 * want + 20]:
            want += 1
        assert prefix_trie._common(x, y) == want


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = made(4, 60) + [
        (3, None, None, None), (3, None, "user", None), (3, 2, None, "x"), (3, 2, None, "x"), (3, 2, "a", "y"),
        (None, 1, "user", "lost"), (20, 0, "user", "long " * 100_000), (21, 0, "u", "s"), (22, 1, "us", ""), (23, 1, "u", "s"), (40, -1, "", ""),
        (7000, 0, "user", "alone"), (7001, 0, "user", "alone"), (7021, 0, "ab", "c"), (7022, 0, "a", "bc"),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", records string, n int").repartition(5)
    own = plain_sequences(rows)
    records = prefix_trie.turn_records(docs)
    assert result(prefix_trie.prefix_trie(records)) == plain_trie(own)
    rebuilt = plain_rebuilt(own)
    assert any(not t for t in rebuilt.values())
    assert result(prefix_trie.prefix_trie(prefix_trie.with_shared_heads(records))) == plain_trie(rebuilt)
    assert result(prefix_trie.prefix_trie(prefix_trie.turn_records(docs.limit(0)))) == []


def test_many_copies_of_one_conversation_spread_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", 50)
    monkeypatch.setattr(prefix_trie, "ROWS", 17)
    rows = [(c, t, "user", f"turn {t if c % 3 else c * 10 + t}") for c in range(600) for t in range(1 + c % 2)]
    rows += [(600 + i, 0, "user", "turn 0") for i in range(300)]
    records = prefix_trie.turn_records(spark.createDataFrame(rows, SCHEMA))
    assert result(prefix_trie.prefix_trie(records)) == plain_trie(plain_sequences(rows))


def test_a_very_long_conversation(spark):
    rows = spark.range(60_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.concat(F.lit("t "), "id").alias("text"))
    rows = rows.unionByName(rows.filter("turn < 50000").withColumn("conv_id", F.lit(2).cast("long")))
    out = prefix_trie.prefix_trie(prefix_trie.turn_records(rows))
    top = out.filter("depth = 0").first()
    assert out.count() == 60_001 and (top.n_convs, top.n_leaves, top.saved_tokens) == (2, 1, 100_000)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(LLM_QUERIES["op11_conversation_prefix_trie"](spark, SMALL)) == plain_trie(plain_rebuilt(plain_sequences(rows)))
