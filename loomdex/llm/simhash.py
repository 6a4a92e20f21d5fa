"""Near duplicates by SimHash, linked through a hierarchical index in Gray order.

1. A text's fingerprint is the bitwise majority over the 64-bit hashes of its word shingles, repeats included.
   Equal fingerprints are one from here on, however many documents have them.
2. The index's upper nodes are masked bit patterns: a mask and the bits that all below share under it. Five masks
   cover the 64 bits, so fingerprints with up to four differing bits meet in a node of one of them; node and pattern are
   the key by which fingerprints are dealt to tasks.
3. A task sorts a node's fingerprints by Gray rank, which brings alike ones together, and builds the lower nodes: runs of
   ``FAN`` neighbours, then runs of runs. Each holds the bits its fingerprints share beyond its parent's. A search adds
   up the differing bits on its way down and leaves a whole group as soon as they are more than allowed.
4. A node with more than ``GROUP`` fingerprints is split by five finer masks over its other bits (again, four
   differences leave one of five equal). One that is still larger is cut into runs in Gray order, and each pair of runs whose
   shared patterns differ in no more bits than allowed is one task's group. All of this is exact.
5. A task gives only as many links as connect what is near. Linked fingerprints form components.

Null, empty and wordless texts have fingerprint zero, which links like any other. A component is named by its
smallest id; one without any id has none. Repeated rows stay rows. Columns other than id and text are ignored; an empty
table gives no rows. Very long texts are hashed slice by slice.
"""

from __future__ import annotations

import re
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import U, flat_bytes, keep, per_task, signed, texts_of
from loomdex.llm.components import components

SHINGLE = 4
SEED = 42
#: Differing bits of two linked fingerprints, at most. One more mask than this covers the bits.
NEAR = 4
#: Fingerprints of a node that one task joins.
GROUP = 8192
#: Neighbours below a node of the tree within a task.
FAN = 16
#: Fingerprints that search the tree at once.
ASKING = 256
#: Bytes of text that are hashed at once.
SLICE = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
LINK = "u long, v long"


def _hash_bits(words: list[bytes], k: int) -> tuple[np.ndarray, int]:
    """How many shingles of k words set each bit (first the highest), and the number of shingles."""
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    found = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts[:n], ends[k - 1 :])), U, n)
    return np.unpackbits(found.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64), n


def fingerprint(text: bytes, k: int = SHINGLE) -> int:
    text = text.lower()  # of bytes: A-Z only
    bits, total, words, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text):
        cut = SPACE.search(text, min(at + SLICE, len(text)))
        end = cut.start() if cut else len(text)
        words = words[-(k - 1) :] if total else words
        words += text[at:end].split()  # of bytes: at the six white space bytes
        if len(words) >= k:
            more, n = _hash_bits(words, k)
            bits, total = bits + more, total + n
        at = end
    if not total and words:
        bits, total = _hash_bits(words, len(words))
    return int.from_bytes(np.packbits(2 * bits > total).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of every row."""

    def make():
        def work(batch):
            data, at = flat_bytes(batch.column("text"))
            found = np.array([fingerprint(data[a:b].tobytes(), k) for a, b in zip(at[:-1], at[1:])], U)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed(found)], names=["doc_id", "fp"])

        return work

    return texts_of(docs).mapInArrow(per_task(make), "doc_id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the sequence of Gray codes, in which neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U(shift))
    return x


class GrayIndex:
    """Tree over different fingerprints in Gray order; ``asked`` rows of it are searched against those after them."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        both, either = self.fps, self.fps
        levels = []  # from the leaves up: pattern bits, mask, last place below
        last = np.arange(len(fps))
        while len(both) > FAN or not levels:
            heads = np.arange(0, len(both), FAN)
            both, either = np.bitwise_and.reduceat(both, heads), np.bitwise_or.reduceat(either, heads)
            last = last[np.minimum(heads + FAN, len(last)) - 1]
            levels.append([both, ~(both ^ either), last])
        for low, high in zip(levels, levels[1:]):  # what the upper node says, its children need not
            low[1] = low[1] & ~np.repeat(high[1], FAN)[: len(low[1])]
        self.levels = levels[::-1]

    def near(self, asked: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of places (a < b, a among ``asked``) that differ in up to ``limit`` bits."""
        pattern, mask, last = self.levels[0]
        who = np.repeat(asked, len(pattern))
        node = np.tile(np.arange(len(pattern)), len(asked))
        apart = np.zeros(len(who), np.uint8)
        for depth, (pattern, mask, last) in enumerate(self.levels):
            if depth:
                who, node, apart = self._below(who, node, apart, len(pattern))
            apart = apart + np.bitwise_count((self.fps[who] ^ pattern[node]) & mask[node])
            good = (apart <= limit) & (last[node] > who)
            who, node, apart = who[good], node[good], apart[good]
        who, place, _ = self._below(who, node, apart, len(self.fps))
        good = (np.bitwise_count(self.fps[who] ^ self.fps[place]) <= limit) & (place > who)
        return who[good], place[good]

    @staticmethod
    def _below(who, node, apart, size):
        child = (node[:, None] * FAN + np.arange(FAN)).ravel()
        there = child < size
        return np.repeat(who, FAN)[there], child[there], np.repeat(apart, FAN)[there]


def connect(fps: np.ndarray, limit: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, fingerprint) that connect all of ``fps`` that are near; each is linked to its group's first."""
    index = GrayIndex(fps)
    root = np.arange(len(fps))
    for low in range(0, len(fps), ASKING):
        a, b = index.near(np.arange(low, min(low + ASKING, len(fps))), limit)
        a, b = root[a], root[b]
        if not (a != b).any():
            continue
        pairs = np.unique(np.minimum(a, b)[a != b] * len(fps) + np.maximum(a, b)[a != b])
        parent = {}

        def top(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for x, y in zip((pairs // len(fps)).tolist(), (pairs % len(fps)).tolist()):
            x, y = sorted((top(x), top(y)))
            if x != y:
                parent[y] = x
        merged = np.arange(len(fps))
        for x in parent:
            merged[x] = top(x)
        root = merged[root]
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return index.fps[linked], index.fps[root[linked]]


def _masks(bits: int, count: int) -> list[int]:
    """The set bits of a mask, dealt into ``count`` masks of neighbouring bits."""
    places = [i for i in range(63, -1, -1) if bits >> i & 1]
    return [sum(1 << i for i in part.tolist()) for part in np.array_split(places, count)]


ALL = (1 << 64) - 1


def _long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _nodes(masks: list[tuple[int, int]]) -> Column:
    """A fingerprint's nodes: number of a mask, and the bits under it."""
    return F.inline(F.array(*(F.struct(F.lit(k).alias("node"), F.col("fp").bitwiseAND(_long(m)).alias("pattern")) for k, m in masks)))


def _join_groups(limit: int, names: list[str]):
    """Whole groups, sorted by the columns ``names``, to links."""

    def run(batches):
        held: list[pa.RecordBatch] = []

        def solve(table):
            key = [table.column(c).to_numpy() for c in names]
            heads = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)])
            fps = table.column("fp").to_numpy().view(U)
            out = [connect(fps[a:b], limit) for a, b in zip(heads, [*heads[1:], len(fps)]) if b - a > 1]
            u, v = (np.concatenate([o[i] for o in out] or [np.zeros(0, U)]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([signed(u), signed(v)], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            key = [table.column(c).to_numpy() for c in names]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) if table.num_rows > 1 else np.zeros(0, int)
            if len(change):  # the last group may go on in the next batch
                yield solve(table.slice(0, int(change[-1]) + 1))
                held = table.slice(int(change[-1]) + 1).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _joined(members: DataFrame, names: list[str], limit: int) -> DataFrame:
    dealt = members.select(*names, "fp").repartition(*names).sortWithinPartitions(*names)
    return dealt.mapInArrow(_join_groups(limit, names), LINK)


def _cut_runs(size: int):
    """Number the runs of a task's rows, which are sorted by node, pattern and Gray rank."""

    def run(batches):
        from pyspark import TaskContext

        number, filled, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            key = list(zip(batch.column("node").to_pylist(), batch.column("pattern").to_pylist()))
            runs = []
            for k in key:
                if k != last or filled >= size:
                    number, filled, last = number + 1, 0, k
                filled += 1
                runs.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, pa.int64())], names=[*batch.schema.names, "run"])

    return run


def _grid(crowded: DataFrame, limit: int, group: int) -> DataFrame:
    """Groups (low, high, fp): each pair of runs of a node whose shared patterns allow near fingerprints."""
    rank = F.col("fp")
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    size = max(group // 2, 1)
    parts = max(1, -(-crowded.count() // (4 * size)))
    ordered = crowded.withColumn("rank", rank.bitwiseXOR(F.lit(-(2**63)).cast("long")))  # unsigned order
    ordered = ordered.repartitionByRange(parts, "node", "pattern", "rank").sortWithinPartitions("node", "pattern", "rank")
    schema = "node int, pattern long, fp long, run long"
    runs = keep(ordered.select("node", "pattern", "fp").mapInArrow(_cut_runs(size), schema), "gray-runs", narrow=True)
    shared = runs.groupBy("node", "pattern", "run").agg(F.bit_and("fp").alias("both"), F.bit_or("fp").alias("any"))
    shared = keep(shared.selectExpr("node", "pattern", "run", "both", "~(both ^ any) as mask"), "gray-patterns", narrow=True)
    a, b = shared.alias("a"), shared.alias("b")
    near = F.expr(f"a.node = b.node and a.pattern = b.pattern and a.run <= b.run and bit_count((a.both ^ b.both) & a.mask & b.mask) <= {limit}")
    pairs = a.join(b, near).selectExpr("a.run as low", "b.run as high")
    cells = pairs.selectExpr("low", "high", "low as run").union(pairs.where("low < high").selectExpr("low", "high", "high as run"))
    return cells.join(runs.select("run", "fp"), "run").select("low", "high", "fp")


def links(fps: DataFrame, limit: int = NEAR, group: int = GROUP) -> DataFrame:
    """Links (u, v) that connect all different fingerprints ``fps`` (fp) with up to ``limit`` differing bits."""
    masks = _masks(ALL, limit + 1)
    finer = [(k, j, mask | more) for k, mask in enumerate(masks) for j, more in enumerate(_masks(ALL & ~mask, limit + 1))]
    nodes = fps.select("fp", _nodes(list(enumerate(masks))))

    def crowded(members: DataFrame) -> DataFrame:
        return members.groupBy("node", "pattern").agg(F.count("*").alias("n")).where(F.col("n") > group).select("node", "pattern")

    key = ["node", "pattern"]
    large = keep(crowded(nodes), "crowded-nodes", narrow=True)
    if large.isEmpty():
        return _joined(nodes, key, limit)
    found = _joined(nodes.join(large, key, "left_anti"), key, limit)
    inside = nodes.join(large, key, "left_semi").select("fp", F.col("node").alias("upper"))
    below = [(len(masks) * (k + 1) + j, mask, k) for k, j, mask in finer]
    split = inside.select("fp", "upper", _nodes([(n, m) for n, m, _ in below]))
    split = keep(split.where(F.floor(F.col("node") / len(masks)) - 1 == F.col("upper")).select("fp", *key), "finer-nodes", narrow=True)
    large = keep(crowded(split), "crowded-nodes", narrow=True)
    if large.isEmpty():
        return found.union(_joined(split, key, limit))
    found = found.union(_joined(split.join(large, key, "left_anti"), key, limit))
    return found.union(_joined(_grid(split.join(large, key, "left_semi"), limit, group), ["low", "high"], limit))


def near_duplicates(docs: DataFrame, limit: int = NEAR, k: int = SHINGLE, group: int = GROUP) -> DataFrame:
    """One row per document: doc_id, fp (64 bits as a long), fingerprint (hex digits), component_id."""
    rows = keep(fingerprints(docs, k), "fingerprints")
    least = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "different-fingerprints", narrow=True)
    roots = components(links(least.select("fp"), limit, group))
    named = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = keep(named, "fingerprint-roots", narrow=True)
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(groups, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
