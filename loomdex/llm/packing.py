"""Best-fit packing by large-item matching.

Texts become token ids and are cut into pieces of at most ``capacity`` ids. Pieces above a third of the
capacity can stand at most two to a sequence: they are matched greedily, the longest with the longest that
still fits. Shorter pieces then go, longest first, to the smallest gap that holds them; what finds no gap
opens new sequences. The plan needs only how many pieces there are of each length, so it is made for counts
(at most ``capacity`` rows on the driver, whatever the corpus); pieces find their place by their number
among those of their length, which comes from sums over tasks and not from one sorted task.

Null and empty texts are packed as their end id alone; a null id stays null; repeated rows are packed each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import keep, per_task, texts_of

#: Added token of the vocabulary, numbered after its ranks.
END = "<|endoftext|>"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"


def encoder(path: str):
    """Byte-level BPE from a file of ranks. The name of the end token in a text is that token, as in the tokenizer's JSON file."""
    import tiktoken

    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END: len(ranks)})


def pieces(docs: DataFrame, ranks_path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: all but the first of a text are full. ``number`` counts a length within a task."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def make():
        encode = partial(encoder(ranks_path).encode, allowed_special="all")
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()

        def work(batch):
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for lo in range(0, len(doc_ids), 256):  # few at a time: memory stays small with long texts
                rows = []
                for doc, text in zip(doc_ids[lo : lo + 256], texts.slice(lo, 256).to_pylist()):
                    ids = np.array([*encode(text), end_id], np.uint32)
                    n = -(-len(ids) // capacity)
                    at = 0
                    for k, end in enumerate(range(len(ids) - capacity * (n - 1), len(ids) + 1, capacity)):
                        part = ids[at:end]
                        rows.append((doc, k, at, end - at, zlib.crc32(part.astype("<u4").tobytes()), task, seen[end - at], part))
                        seen[end - at] += 1
                        at = end
                doc, k, at, length, crc, where, number, ids = zip(*rows)
                columns = [
                    pa.array(doc, pa.int64()), pa.array(k, pa.int32()), pa.array(at, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()), pa.array(where, pa.int32()), pa.array(number, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
                if with_ids:
                    columns.append(pa.array([i.view(np.int32) for i in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

        return work

    return texts_of(docs).mapInArrow(per_task(make), schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Sequences as (how many alike, the lengths in each), for ``counts`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    large = sorted(n for n in left if 3 * n > capacity)
    groups: list[tuple[int, list[int]]] = []
    gaps: dict[int, list[tuple[int, list[int]]]] = {}

    def put(count: int, lengths: list[int]) -> None:
        gap = capacity - sum(lengths)
        if gap == 0:
            groups.append((count, lengths))
            return
        if not gaps.get(gap):
            insort(order, gap)
            gaps[gap] = []
        gaps[gap].append((count, lengths))

    order: list[int] = []
    while large:
        a = large[-1]
        at = bisect_left(large, capacity - a + 1) - 1
        if at < 0:
            put(left.pop(a), [a])
            large.pop()
            continue
        b = large[at]
        n = left[a] // 2 if a == b else min(left[a], left[b])
        if n == 0:  # one of a is left: it goes with the next shorter one, or alone
            left[a] -= 1
            put(1, [a, large[at - 1]] if at else [a])
            if at:
                left[large[at - 1]] -= 1
        else:
            put(n, [a, b])
            left[a] -= n
            left[b] -= n
        large = [x for x in large if left[x] > 0] if left[a] == 0 or left[b] == 0 or n == 0 else large
    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        count = left[s]
        while count:
            at = bisect_left(order, s)
            if at == len(order):
                each = capacity // s
                if count >= each:
                    put(count // each, [s] * each)
                if count % each:
                    put(1, [s] * (count % each))
                break
            gap = order[at]
            alike, lengths = gaps[gap].pop()
            if not gaps[gap]:
                order.pop(at)
            n = min(alike, count)
            if alike > n:
                put(alike - n, lengths)
            put(n, [*lengths, s])
            count -= n
    return groups + [g for gap in order for g in gaps[gap]]


def slots(groups: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first number, first sequence, offset): where the pieces of each length go, in order."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in groups:
        offset = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + count
            offset += n
        sequence += count
    found = np.array(rows, np.int64).reshape(-1, 4)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def pack(docs: DataFrame, ranks_path: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences: one row per piece with its sequence and offset there.

    ``with_ids`` adds the token ids of each piece. Sequences are numbered from 0 without holes.
    """
    spark = docs.sparkSession
    cut = keep(pieces(docs, ranks_path, capacity, end_id, with_ids), "pieces")
    per_task_counts = cut.groupBy("task", "length").agg((F.max("number") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = keep(per_task_counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-counts")
    counts = {r.length: r.n for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    placed = spark.sparkContext.broadcast(slots(plan(counts, capacity)))  # its size depends on capacity only

    def place(batches):
        length, number, sequence, offset = placed.value.T
        start = length * (1 << 44) + number
        for batch in batches:
            n = batch.column("length").to_numpy()
            own = n * (1 << 44) + batch.column("number").to_numpy()
            slot = np.searchsorted(start, own, "right") - 1
            found = {"sequence_id": sequence[slot] + own - start[slot], "offset": offset[slot]}
            kept = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array(v) for v in found.values())], names=[*kept, *found]
            )

    # Merged, not broadcast: the sums have up to ``capacity`` rows for each task, so they grow with the corpus.
    numbered = cut.join(before.select("task", "length", "before").hint("merge"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number")).alias("number"),
        *(["ids"] if with_ids else []),
    )
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return numbered.mapInArrow(place, schema + ", sequence_id long, offset long")
