"""Substring removal by seed and extend over words.

1. Winnowing: each window of ``least`` words chooses the smallest hash of its ``gram``-word strings as its anchor;
   equal windows choose equal anchors at equal distance. Neighbouring windows with the same anchor are one row.
2. Rows are counted by (anchor, content) first. Copies are one row with the smallest id that has them: in all
   other documents all of their windows are repeats.
3. Documents are joined on anchors that have several different contents. From the anchor, each is extended
   both ways against those with a smaller id; common runs of at least ``least`` words are maximal repeats.
4. Anchors with more than ``PAIRS`` contents would give too many pairs: the task finds for the hash of each of
   their windows the smallest id instead. Above ``group`` contents, all executors do so together.
5. Repeats are merged per document, and their words go.

Words are told apart by 64-bit hashes. Null texts have no words; a null id counts as larger than all others; rows with
the same id are one document, so they remove nothing from each other; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import U, Rolling, blocks, flat_bytes, keep, mix, per_task, ranges, signed, texts_of, winnow
from loomdex.llm.words import SOLID, hashed_words

LEAST = 50
GRAM = 10
#: Contents of an anchor that are extended against each other, and contents that one task takes.
PAIRS, GROUP = 64, 20_000
#: Words that a task extends at once.
BLOCK_WORDS = 400_000
LAST = 2**63 - 1


def keyed(docs: DataFrame) -> DataFrame:
    return texts_of(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("key"), F.xxhash64("text").alias("mark"), "doc_id", "text")


def segments(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """Rows with the same anchor in neighbouring windows: places are counted in words."""
    schema = "anchor long, content long, key long, mark long, place int, windows int, lead int"

    def make():
        def work(batch):
            key, mark = batch.column("key").to_numpy(), batch.column("mark").to_numpy()
            for row, end, data, at in blocks(batch):
                words, _, _, first = hashed_words(data, at, SOLID, fold=False)
                doc = np.repeat(np.arange(end - row), np.diff(first))
                valid = np.arange(len(words)) + least <= first[1:][doc]
                roll = Rolling(words)
                grams = roll.windows(gram)
                place, low, high = winnow(grams, least - gram + 1, valid)
                if len(place):
                    own = doc[low]
                    columns = {
                        "anchor": signed(grams[place]),
                        "content": signed(roll.spans(low, high + least)),
                        "key": pa.array(key[row + own]),
                        "mark": pa.array(mark[row + own]),
                        "place": pa.array((low - first[own]).astype(np.int32)),
                        "windows": pa.array((high - low + 1).astype(np.int32)),
                        "lead": pa.array((place - low).astype(np.int32)),
                    }
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return work

    return docs.select("key", "mark", "text").mapInArrow(per_task(make), schema)


def _fetch(least: int):
    """The word hashes of the asked rows."""
    names = ["anchor", "content", "id", "windows", "lead"]

    def make():
        def work(batch):
            asked = batch.column("asked")
            per_row = np.diff(asked.offsets.to_numpy())
            parts = asked.flatten()
            field = {n: parts.field(n).to_numpy() for n in [*names, "place"]}
            ends = np.cumsum(per_row)
            for row, end, data, at in blocks(batch):
                words, _, _, first = hashed_words(data, at, SOLID, fold=False)
                part = slice(ends[row] - per_row[row], ends[end - 1])
                start = np.repeat(first[:-1], per_row[row:end]) + field["place"][part]
                size = field["windows"][part].astype(np.int64) + least - 1
                for lo in range(0, len(start), 4096):
                    s, n = start[lo : lo + 4096], size[lo : lo + 4096]
                    offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                    lists = pa.ListArray.from_arrays(offsets, signed(words[ranges(s, n)]))
                    columns = [pa.array(field[c][part][lo : lo + 4096]) for c in names]
                    yield pa.RecordBatch.from_arrays([*columns, lists], names=[*names, "words"])

        return work

    return per_task(make)


def extend(anchor: np.ndarray, ids: np.ndarray, lead: np.ndarray, size: np.ndarray, words: np.ndarray, least: int):
    """Repeats of rows sorted by anchor and id: row, first and last repeated window of each (they may overlap)."""
    n = len(size)
    start = np.cumsum(size) - size
    width = int(size.max())
    # Row i's words from its anchor on, and before it backwards; what is missing never equals anything.
    right = np.arange(n * width, dtype=U).reshape(n, width) ^ mix(np.arange(n, dtype=U))[:, None]
    left = ~right
    row = np.repeat(np.arange(n), size)
    off = np.arange(len(words)) - start[row] - lead[row]
    ahead = off >= 0
    right[row[ahead], off[ahead]] = words[ahead]
    left[row[~ahead], -1 - off[~ahead]] = words[~ahead]
    group = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    before = np.arange(n) - np.repeat(group, np.diff(np.r_[group, n]))  # rows of the anchor with a smaller or equal id
    i = np.repeat(np.arange(n), before)
    j = ranges(np.arange(n) - before, before)
    smaller = ids[j] < ids[i]
    i, j = i[smaller], j[smaller]
    out = []
    for lo in range(0, len(i), 20_000):
        a, b = i[lo : lo + 20_000], j[lo : lo + 20_000]
        more, less = (_common(m[a], m[b]) for m in (right, left))
        long = np.flatnonzero(more + less >= least)
        out.append(np.stack([a[long], (lead[a] - less)[long], (lead[a] + more)[long] - least]))
    found = np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)
    return np.unique(found, axis=1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = np.c_[a != b, np.ones(len(a), bool)]
    return differ.argmax(axis=1)


def owned_windows(anchor: np.ndarray, ids: np.ndarray, size: np.ndarray, words: np.ndarray, least: int):
    """Windows of rows that a row of the same anchor with a smaller id has: row, place and place again."""
    count = size - least + 1
    start = ranges(np.cumsum(size) - size, count)
    own = np.repeat(np.arange(len(size)), count)
    window = Rolling(words).spans(start, start + least) ^ mix(anchor.view(U))[own]
    order = np.lexsort((ids[own], window))
    head = np.flatnonzero(np.r_[True, window[order][1:] != window[order][:-1]])
    least_id = np.repeat(ids[own[order[head]]], np.diff(np.r_[head, len(order)]))
    late = np.sort(order[ids[own[order]] > least_id])
    low = start[late] - (np.cumsum(size) - size)[own[late]]
    return np.stack([own[late], low, low])


def _extend(least: int, limit: int, pairs: int):
    def solve(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("words").combine_chunks()
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        words = lists.flatten().to_numpy().view(U)
        anchor, ids, lead = (table.column(c).to_numpy() for c in ("anchor", "id", "lead"))
        _, group, n = np.unique(anchor, return_inverse=True, return_counts=True)
        found = []
        for rows, many in ((np.flatnonzero(n[group] <= pairs), False), (np.flatnonzero(n[group] > pairs), True)):
            if not len(rows):
                continue
            part = words[ranges((np.cumsum(size) - size)[rows], size[rows])]
            if many:
                out = owned_windows(anchor[rows], ids[rows], size[rows], part, least)
            else:
                out = extend(anchor[rows], ids[rows], lead[rows].astype(np.int64), size[rows], part, least)
            found.append(np.stack([rows[out[0]], out[1], out[2]]))
        own, low, high = np.concatenate(found, axis=1)
        out = [table.column(c).combine_chunks().take(pa.array(own)) for c in ("anchor", "content")]
        return pa.RecordBatch.from_arrays([*out, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["anchor", "content", "low", "high"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            size = np.cumsum(np.asarray(table.column("windows").to_numpy(), np.int64) + least)
            if size[-1] < limit:
                continue
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            done = 0
            for k in range(1, len(starts)):  # the last anchor may go on in the next batch
                if size[starts[k] - 1] - (size[done - 1] if done else 0) >= limit or k == len(starts) - 1:
                    yield solve(table.slice(done, starts[k] - done))
                    done = starts[k]
            held = table.slice(done).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held))

    return run


def _windows(least: int):
    def make():
        def work(batch):
            lists = batch.column("words")
            at = lists.offsets.to_numpy().astype(np.int64)
            roll = Rolling(lists.flatten().to_numpy().view(U))
            at = at - at[0]
            count = batch.column("windows").to_numpy().astype(np.int64)
            start = ranges(at[:-1], count)
            own = np.repeat(np.arange(len(count)), count)
            columns = {c: batch.column(c).take(pa.array(own)) for c in ("anchor", "content", "id")}
            columns |= {"low": pa.array((start - at[:-1][own]).astype(np.int32)), "window": signed(roll.spans(start, start + least))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return work

    return per_task(make)


def repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM, group: int = GROUP, pairs: int = PAIRS) -> DataFrame:
    """Spans of words (key, mark, start, end) that documents with a smaller id have too. They may overlap."""
    found = keep(segments(docs, least, gram), "segments")
    kinds = found.groupBy("anchor", "content").agg(
        F.min("key").alias("id"), F.max("key").alias("last"), *(F.first(c).alias(c) for c in ("key", "mark", "place", "windows", "lead"))
    )
    kinds = keep(kinds, "segment-kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    asked = keep(
        kinds.join(several, "anchor")
        .withColumn("asked", F.struct("anchor", "content", "id", "place", "windows", "lead"))
        .groupBy("key", "mark")
        .agg(F.collect_list("asked").alias("asked")),  # of one text
        "segments-asked",
    )
    texts = docs.join(asked, ["key", "mark"]).select("key", "mark", "text", "asked").dropDuplicates(["key", "mark"])
    fetched = keep(
        texts.select("text", "asked").mapInArrow(
            _fetch(least), "anchor long, content long, id long, windows int, lead int, words array<long>"
        ),
        "segment-words",
    )
    large = several.where(F.col("kinds") > group).select("anchor")
    small = (
        fetched.join(large, "anchor", "left_anti")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "id")
        .mapInArrow(_extend(least, BLOCK_WORDS, pairs), "anchor long, content long, low int, high int")
    )
    windows = fetched.join(large, "anchor", "left_semi").mapInArrow(
        _windows(least), "anchor long, content long, id long, low int, window long"
    )
    first = windows.groupBy("anchor", "window").agg(F.min("id").alias("first"))
    spread = windows.join(first, ["anchor", "window"]).where("first < id").selectExpr("anchor", "content", "low", "low as high")
    everyone = F.lit(-(2**63)).alias("after")
    whole = kinds.where("last > id").selectExpr("anchor", "content", "id as after", "0 as low", "windows - 1 as high")
    known = small.unionByName(spread).select("anchor", "content", everyone, "low", "high").unionByName(whole)
    return (
        found.join(known, ["anchor", "content"])
        .where((F.col("key") > F.col("after")) | (F.col("after") == -(2**63)))
        .select("key", "mark", (F.col("place") + F.col("low")).alias("start"), (F.col("place") + F.col("high") + least).alias("end"))
    )


def _cut(with_text: bool):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text

    def make():
        def work(batch):
            data, at = flat_bytes(batch.column("text"))
            rows = []
            for i, (doc, spans) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist())):
                words = data[at[i] : at[i + 1]].tobytes().split()  # at white space of ASCII
                kept, done = words, 0
                if spans:
                    kept = []
                    for start, end in sorted((s["start"], s["end"]) for s in spans):
                        kept += words[done : max(done, start)]
                        done = max(done, end)
                    kept += words[done:]
                text = b" ".join(kept)
                rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None)[: len(names)])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        return work

    return per_task(make)


def remove_repeats(docs: DataFrame, least: int = LEAST, with_text: bool = False, **options) -> DataFrame:
    """One row per document: how many words go, and a digest of those that stay.

    A word goes if ``least`` consecutive words around it also stand in a document with a smaller id, judged on the
    input. ``with_text`` adds the words that stay, joined by spaces, as ``kept``.
    """
    rows = keyed(docs)
    spans = repeats(rows, least, **options).groupBy("key", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = rows.join(spans, ["key", "mark"], "left").select("doc_id", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return joined.mapInArrow(_cut(with_text), schema)
