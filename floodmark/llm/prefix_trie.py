"""The trie of turn sequences that conversations share from their start.

Conversations are sorted by their turns over the whole cluster. Runs of neighbours are blocks; in each, a union-find takes
the edges between sorted neighbours, deepest common prefix first, and every merge of components is a branching node. What
lies on the paths to a block's first and last sequence may go on in other blocks: each block's forest is contracted to those
paths, and the paths of all blocks are merged node by node. All other nodes are complete within their block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodmark.llm.batches import map_batches
from floodmark.llm.scratch import Scratch
from floodmark.llm.text import column, words

#: Bytes of a turn in a sequence: 16 of the digest of role and text, 4 of the words in the text.
DIGEST, RECORD = 16, 20
#: Conversations, and bytes of their sequences, from which a block is closed. Results don't depend on it.
BLOCK_ROWS, BLOCK_BYTES = 1 << 14, 4 << 20
#: Rows of a batch that a worker hands back.
ROWS = 1 << 14
NO_ENDS = hashlib.sha256(b"").hexdigest()
#: What a block emits: a node with its parent, a node whose parent is on a path, a node of a path.
INNER, HANGING, PATH = 0, 1, 2
EMITTED = (
    "kind int, block long, side int, depth long, conv long, parent_conv long, n long, children long, leaves long, "
    "saved long, ends string, node binary, parent binary, words long"
)
_ARROW = pa.schema([
    ("kind", pa.int32()), ("block", pa.int64()), ("side", pa.int32()), ("depth", pa.int64()), ("conv", pa.int64()),
    ("parent_conv", pa.int64()), ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
    ("ends", pa.string()), ("node", pa.binary()), ("parent", pa.binary()), ("words", pa.int64()),
])


def turn_records(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id long, records array<string>): each conversation's turns in order, as hex of digest and number of words.

    Turns are ordered by `turn_col`, null first, equal ones by role and the digest of the text; repeated rows are turns
    of their own. Null role or text is empty. Rows without conversation id belong to none and are left out. Texts stay
    where they are read; a turn moves as 40 characters, and one task holds those of one conversation.
    """
    role = F.coalesce(column(role_col), F.lit(""))
    text = F.coalesce(column(text_col), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST)
    record = F.concat(digest, F.lpad(F.hex(F.size(words(text))), 2 * (RECORD - DIGEST), "0"))
    turns = conversations.filter(column(id_col).isNotNull()).select(
        column(id_col).cast("long").alias("conv_id"),
        F.struct(column(turn_col).alias("turn"), role.alias("role"), record.alias("record")).alias("turn"))
    ordered = F.sort_array(F.collect_list("turn"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: t["record"]).alias("records"))


def with_shared_heads(records: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Records rebuilt: the first h of conversation c - c % every (all if fewer, none if absent), then the own ones after
    the first h, with h = crc32(decimal c) % (most + 1). One row per conversation, with or without turns."""
    own = records.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    heads = records.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("records", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    rest = F.slice(F.col("records"), h + 1, F.greatest(F.size("records") - h, F.lit(0)))
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h)
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("records"))


def _common(a: bytes, b: bytes) -> int:
    """Leading records that two sequences share, in time linear in the shared part."""
    at, step, end = 0, RECORD, min(len(a), len(b))
    while at < end:
        if a[at : at + step] == b[at : at + step] and at + step <= end:
            at += step
            step *= 2
        elif step > RECORD:
            step = RECORD * max(1, step // RECORD // 4)
        else:
            break
    return at // RECORD


def _prefix_digests(key: bytes) -> list[bytes]:
    h = hashlib.sha256()
    out = [h.digest()[:DIGEST]]
    for at in range(0, len(key), RECORD):
        h.update(key[at : at + RECORD])
        out.append(h.copy().digest()[:DIGEST])
    return out


class Forest:
    """The compressed trie of a block of sorted sequences, by union-find over the edges between neighbours."""

    def __init__(self, keys: list[bytes], ids: list[int]) -> None:
        starts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
        self.keys = [keys[i] for i in starts]
        self.members = [ids[a:b] for a, b in zip(starts, starts[1:] + [len(keys)])]
        m = len(self.keys)
        # A node: depth, members, smallest member, first and last class, the class that ends here, children.
        self.depth = [len(k) // RECORD for k in self.keys]
        self.n = [len(x) for x in self.members]
        self.low = [min(x) for x in self.members]
        self.span = [(i, i) for i in range(m)]
        self.ends: list[int | None] = list(range(m))
        self.children: list[list[int]] = [[] for _ in range(m)]
        self.gone: set[int] = set()
        edges = np.array([_common(a, b) for a, b in zip(self.keys, self.keys[1:])], dtype=np.int64)
        link, top = list(range(m)), list(range(m))

        def find(x: int) -> int:
            while link[x] != x:
                link[x] = link[link[x]]
                x = link[x]
            return x

        for e in np.argsort(-edges, kind="stable").tolist():
            a, b = find(e), find(e + 1)
            link[b] = a
            top[a] = self._merge(top[a], top[b], int(edges[e]))
        self.root = top[find(0)]
        if self.depth[self.root]:
            self.root = self._node(0, [self.root])

    def _node(self, depth: int, children: list[int]) -> int:
        self.depth.append(depth)
        self.n.append(sum(self.n[c] for c in children))
        self.low.append(min(self.low[c] for c in children))
        self.span.append((min(self.span[c][0] for c in children), max(self.span[c][1] for c in children)))
        self.ends.append(None)
        self.children.append(children)
        return len(self.depth) - 1

    def _merge(self, a: int, b: int, depth: int) -> int:
        """The node at `depth` above two components: one of their tops if it is there already, else a new one."""
        at = [x for x in (a, b) if self.depth[x] == depth]
        if not at:
            return self._node(depth, [a, b])
        keep, other = (at[0], b if at[0] == a else a)
        if len(at) == 2:
            if len(self.children[other]) > len(self.children[keep]):
                keep, other = other, keep
            self.children[keep] += self.children[other]
            self.ends[keep] = self.ends[keep] if self.ends[keep] is not None else self.ends[other]
            self.gone.add(other)
        else:
            self.children[keep].append(other)
        self.n[keep] += self.n[other]
        self.low[keep] = min(self.low[keep], self.low[other])
        (x, y), (z, w) = self.span[keep], self.span[other]
        self.span[keep] = (min(x, z), max(y, w))
        return keep

    def _words(self, v: int, depth: int) -> int:
        at = depth * RECORD
        return int.from_bytes(self.keys[self.span[v][0]][at - RECORD + DIGEST : at], "big") if depth else 0

    def _ids(self, v: int) -> str | None:
        return None if self.ends[v] is None else ",".join(map(str, self.members[self.ends[v]]))

    def emit(self, block: int) -> Iterator[tuple]:
        """Rows of EMITTED: all nodes, and those of the paths to the first and last sequence as contributions."""
        last = len(self.keys) - 1
        alive = sorted((v for v in range(len(self.depth)) if v not in self.gone), key=lambda v: -self.depth[v])
        above: dict[int, int] = {c: v for v in alive for c in self.children[v]}
        leaves, saved = [0] * len(self.depth), [0] * len(self.depth)
        open_ = {v for v in alive if self.span[v][0] == 0 or self.span[v][1] == last}
        for v in alive:  # deepest first: inner nodes below a node are done before it
            p = above.get(v)
            top = self.depth[p] + 1 if p is not None else 0
            inner = [c for c in self.children[v] if c not in open_]
            if v in open_:
                continue
            leaves[v] = sum(leaves[c] for c in inner) or 1
            total, ids, n = sum(saved[c] for c in inner), self._ids(v), self.n[v]
            ends = NO_ENDS if ids is None else hashlib.sha256(ids.encode()).hexdigest()
            for depth in range(self.depth[v], top - 1, -1):
                total += (n - 1) * self._words(v, depth)
                bottom, upper = depth == self.depth[v], depth == top
                hangs = upper and p in open_
                yield (
                    HANGING if hangs else INNER, block, None if not hangs else 0 if self.span[p][0] == 0 else 1, depth,
                    self.low[v], None if hangs else self.low[p] if upper else self.low[v], n,
                    len(inner) if bottom else 1, leaves[v], total, ends if bottom else NO_ENDS, None, None, None,
                )
            saved[v] = total
        shared = _common(self.keys[0], self.keys[last]) if last else len(self.keys[0]) // RECORD
        for side, end in enumerate((0, last) if last else (0,)):
            names = _prefix_digests(self.keys[end])
            path = sorted((v for v in open_ if self.span[v][0] <= end <= self.span[v][1]), key=lambda v: self.depth[v])
            depth = 0
            for v in path:
                inner = [c for c in self.children[v] if c not in open_]
                while depth <= self.depth[v]:
                    # What both paths share counts on the first one only; the second has it for its place in the path.
                    own, bottom = side == 0 or depth > shared, depth == self.depth[v]
                    given = inner if own and bottom else []
                    yield (
                        PATH, block, side, depth, self.low[v], None, self.n[v] if own else 0, len(given),
                        sum(leaves[c] for c in given), sum(saved[c] for c in given), self._ids(v) if own and bottom else None,
                        names[depth], names[depth - 1] if depth else None, self._words(v, depth),
                    )
                    depth += 1


def _batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), _ARROW)], schema=_ARROW)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), _ARROW)], schema=_ARROW)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a sorted partition, each as its nodes and paths; a sequence's conversations may span blocks."""
    partition, count = TaskContext.get().partitionId(), 0

    def blocks() -> Iterator[tuple[list, list]]:
        keys, ids, size = [], [], 0
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(ids) >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    yield keys, ids
                    keys, ids, size = [], [], 0
                # Equal neighbours are one object, so copies of a long sequence take no room of their own.
                keys.append(keys[-1] if keys and keys[-1] == key else key)
                size += len(key) if len(keys) < 2 or keys[-1] is not keys[-2] else 0
                ids.append(conv)
        if ids:
            yield keys, ids

    for keys, ids in blocks():
        yield from _batched(Forest(keys, ids).emit((partition << 32) + count))
        count += 1


def _hash_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists of ids, joined in the order they come; one state is held at a time."""
    names = ["node", "ends"]
    node, state = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.binary(), pa.string()))], names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names)


def prefix_trie(records: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per node, all columns long but the last: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    `records` has conv_id and the conversation's turns as of :func:`turn_records`. A node is a distinct sequence of first
    turns, from the root (no turn); conversations that start with it are its members. conv_id is the smallest member,
    parent_conv_id that of the node without the last turn (root: null), n_children the nodes one turn longer, n_leaves the
    childless nodes below it (itself if it is one), saved_tokens the sum over the node and all below it of (members - 1)
    times the words of its last turn, ends_sha256 the hash of the members with no further turn.

    No conversations: no row, not even a root. Conversations without turns are members of the root. Ids should be
    distinct; a repeated row counts as one more member. Equal conversations, and turns that very many share, spread over
    blocks and tasks like others; per block only the paths to its ends move on.
    """
    scratch = scratch or Scratch(records.sparkSession)
    keys = records.select(F.unhex(F.array_join("records", "")).alias("key"), "conv_id")
    ordered = keys.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    emitted = scratch.keep(map_batches(ordered, _forests, EMITTED))

    path = emitted.filter(F.col("kind") == PATH)
    met = path.groupBy("node").agg(
        F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("words").alias("words"), F.min("conv").alias("conv"),
        F.sum("n").alias("n"), F.sum("children").alias("inner"), F.min(F.struct("block", "side")).alias("owner"))
    below = met.filter("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("outer"))
    tops = scratch.keep(met.join(below, "node", "left").withColumn("children", F.col("inner") + F.coalesce("outer", F.lit(0))))

    # A node of paths counts itself once, on the path of its owner; sums run up each path.
    whole = tops.select("node", F.col("conv").alias("top_conv"), F.col("n").alias("top_n"), F.col("children").alias("top_children"), "owner")
    owned = F.col("owner") == F.struct("block", "side")
    up = Window.partitionBy("block", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    climbed = path.join(whole, "node").select(
        "block", "side", "depth", "node", F.col("top_conv").alias("conv"),
        F.sum(F.col("leaves") + F.when(owned & (F.col("top_children") == 0), 1).otherwise(0)).over(up).alias("leaves"),
        F.sum(F.col("saved") + F.when(owned, (F.col("top_n") - 1) * F.col("words")).otherwise(0)).over(up).alias("saved"))
    paths = scratch.keep(climbed)
    sums = paths.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    lists = path.filter("ends is not null").select("node", "ends", "block").repartition("node").sortWithinPartitions("node", "block")
    hashes = map_batches(lists.select("node", "ends"), _hash_in_order, "node binary, ends string")
    parents = tops.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    outer = (
        tops.join(sums, "node").join(hashes, "node", "left").join(parents, "parent", "left")
        .withColumn("ends", F.coalesce("ends", F.lit(NO_ENDS)))
    )
    places = paths.select("block", "side", (F.col("depth") + 1).alias("depth"), F.col("conv").alias("parent_conv"))
    hanging = emitted.filter(F.col("kind") == HANGING).drop("parent_conv").join(places, ["block", "side", "depth"])
    inner = emitted.filter(F.col("kind") == INNER)
    columns = {
        "conv": "conv_id", "depth": "depth", "parent_conv": "parent_conv_id", "n": "n_convs", "children": "n_children",
        "leaves": "n_leaves", "saved": "saved_tokens", "ends": "ends_sha256",
    }
    shown = [F.col(a).alias(b) for a, b in columns.items()]
    return inner.select(shown).unionByName(hanging.select(shown)).unionByName(outer.select(shown))
