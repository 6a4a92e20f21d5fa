"""Removal of byte strings that occur more than once, by threshold-bounded interval expansion.

1. Winnowing: each window of ``least`` bytes chooses the smallest hash of its ``gram``-byte strings, its
   anchor. Equal windows choose equal anchors at equal distance, so all copies of a window meet under one key.
   Neighbouring windows with the same anchor form a segment; rows are one per segment, not per byte.
2. Segments are counted by (anchor, content) before anything is grouped: copies by the thousand become one
   row with a count, and all their windows are repeated.
3. Where an anchor has several different segments, their texts are fetched and packed into blocks of whole
   anchors, of bounded size. Each block gets a Burrows-Wheeler transform; breadth-first backward extension finds
   common prefixes by increasing length and stops at ``least``: what has no value by then is repeated.
4. An anchor with more than ``group`` different segments (a passage that very many documents share, at its
   edges) would be too much for a task: its windows are counted by hash over all executors instead, exactly. Stretches of
   neighbouring windows come first. What is equal as a whole is repeated; what shares its core, the bytes
   common to its windows, with no other is not; only the rest is spelled out, a row per window.
5. Repeated windows are merged per document and cut out.

Segments and windows are told apart by 64-bit hashes within an anchor. Null texts count as empty; rows that
repeat in the input are copies of each other; a null id stays null; empty tables give no rows; columns other
than id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.llm.bwt import repeated_starts
from loomdex.llm.common import (
    Rolling, blocks, byte_codes, flat_bytes, keep, per_task, ranges, signed, texts_of, winnow,
)

LEAST = 400
GRAM = 64
#: Bytes of one transform.
TRANSFORM = 1_000_000
#: Different segments of one anchor that a task takes.
GROUP = 2_000
#: Neighbouring windows of a very large anchor that are compared as one at first.
STRETCH = 16


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that equal rows share; it needs no order and so is the same in every run."""
    return texts_of(docs).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("key"), F.xxhash64("text").alias("mark"), "doc_id", "text"
    )


def segments(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """Segments of keyed rows: anchor, content hash, place of the first window, windows, bytes before the anchor."""
    schema = "anchor long, content long, key long, mark long, place int, windows int, lead int"

    def make():
        def work(batch):
            key, mark = batch.column("key").to_numpy(), batch.column("mark").to_numpy()
            for row, end, data, at in blocks(batch):
                doc = np.repeat(np.arange(end - row), np.diff(at))
                valid = np.arange(len(data)) + least <= at[1:][doc]
                roll = Rolling(byte_codes(data))
                grams = roll.windows(gram)
                place, first, last = winnow(grams, least - gram + 1, valid)
                if len(place):
                    own = doc[first]
                    columns = {
                        "anchor": signed(grams[place]),
                        "content": signed(roll.spans(first, last + least)),
                        "key": pa.array(key[row + own]),
                        "mark": pa.array(mark[row + own]),
                        "place": pa.array((first - at[own]).astype(np.int32)),
                        "windows": pa.array((last - first + 1).astype(np.int32)),
                        "lead": pa.array((place - first).astype(np.int32)),
                    }
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return work

    return docs.select("key", "mark", "text").mapInArrow(per_task(make), schema)


def _fetch(least: int):
    """Cut the asked segments out of the texts."""

    def make():
        def work(batch):
            data, at = flat_bytes(batch.column("text"))
            asked = batch.column("asked")
            per_row = np.diff(asked.offsets.to_numpy())
            parts = asked.flatten()
            field = {n: parts.field(n).to_numpy() for n in ("anchor", "content", "n", "place", "windows", "lead")}
            start = np.repeat(at[:-1], per_row) + field["place"]
            size = field["windows"].astype(np.int64) + least - 1
            for lo in range(0, len(start), 4096):  # bounded batches
                part = slice(lo, lo + 4096)
                texts = data[ranges(start[part], size[part])].tobytes()
                offsets = np.r_[0, np.cumsum(size[part])].astype(np.int32)
                text = pa.Array.from_buffers(pa.binary(), len(size[part]), [None, pa.py_buffer(offsets), pa.py_buffer(texts)])
                columns = [pa.array(field[n][part]) for n in ("anchor", "content", "n", "windows", "lead")]
                yield pa.RecordBatch.from_arrays([*columns, text], names=["anchor", "content", "n", "windows", "lead", "bytes"])

        return work

    return per_task(make)


def _runs(hit: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of hits within one owner."""
    if not len(hit):
        return hit.astype(np.int64), hit.astype(np.int64)
    begin = hit & np.r_[True, ~hit[:-1] | (owner[1:] != owner[:-1])]
    stop = hit & np.r_[~hit[1:] | (owner[1:] != owner[:-1]), True]
    return np.flatnonzero(begin), np.flatnonzero(stop)


def _expand(least: int, limit: int):
    """Whole anchors, sorted, to repeated windows of their segments."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        data, at = flat_bytes(table.column("bytes"))
        size = np.diff(at)
        n = len(size)
        symbols = np.zeros(len(data) + n, np.uint8)
        owner = np.repeat(np.arange(n), size)
        where = np.arange(len(data)) + owner  # a 0 follows each segment
        symbols[where] = data + 1  # UTF-8 has no byte 255
        room = np.zeros(len(symbols), np.int64)
        room[where] = at[1:][owner] - np.arange(len(data))
        first, last = _runs(repeated_starts(symbols, room, least)[where], owner)
        own = owner[first]
        once = table.column("n").to_numpy()[own] == 1  # of the others, all windows are known to be repeated
        first, last, own = first[once], last[once], own[once]
        out = [table.column(c).combine_chunks().take(pa.array(own)) for c in ("anchor", "content")]
        return pa.RecordBatch.from_arrays(
            [*out, pa.array((first - at[own]).astype(np.int32)), pa.array((last - at[own]).astype(np.int32))],
            names=["anchor", "content", "low", "high"],
        )

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) * least < limit:
                continue
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            size = np.r_[0, np.cumsum(np.asarray(table.column("windows").to_numpy(), np.int64) + least)]
            done = 0  # the last anchor may go on in the next batch
            for this, after in zip(starts[:-1], starts[1:]):
                if this > done and size[after] - size[done] > limit:
                    yield solve(table.slice(done, this - done))
                    done = this
            held = table.slice(done).to_batches()
        rest = pa.Table.from_batches(held) if held else None
        while rest is not None and rest.num_rows:
            anchor = rest.column("anchor").to_numpy()
            size = np.cumsum(np.asarray(rest.column("windows").to_numpy(), np.int64) + least)
            ends = np.r_[np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor)]
            cut = int(ends[max(0, np.searchsorted(size[ends - 1], limit, "right") - 1)])
            yield solve(rest.slice(0, cut))
            rest = rest.slice(cut)

    return run


def _stretches(least: int, width: int):
    """Segments of very large anchors in stretches of up to ``width`` windows, cut at the same distances from the anchor.

    A window lies ``lead`` less its place in front of the anchor. Equal windows lie equally far and so are of equal
    ``turn``, and what all windows of a turn have in common (``core``) is equal around them.
    """

    def make():
        def work(batch):
            data, at = flat_bytes(batch.column("bytes"))
            roll = Rolling(byte_codes(data))
            count, lead = (batch.column(c).to_numpy().astype(np.int64) for c in ("windows", "lead"))
            turns = lead // width - (lead - count + 1) // width + 1
            turn = ranges((lead - count + 1) // width, turns)
            own = np.repeat(np.arange(len(count)), turns)
            begin, count, lead = at[:-1][own], count[own], lead[own]
            last = lead - turn * width  # place of the turn's nearest window, in this segment or behind it
            low, high = np.maximum(last - width + 1, 0), np.minimum(last, count - 1)
            columns = {c: batch.column(c).take(pa.array(own)) for c in ("anchor", "content", "n")}
            columns |= {c: pa.array(x.astype(np.int32)) for c, x in (("low", low), ("high", high), ("near", lead - high), ("far", lead - low), ("turn", turn))}
            columns["core"] = signed(roll.spans(begin + last, begin + last - width + 1 + least))
            columns["bytes"] = signed(roll.spans(begin + low, begin + high + least))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return work

    return per_task(make)


def _windows(least: int):
    """One row per window of the asked stretches."""

    def make():
        def work(batch):
            data, at = flat_bytes(batch.column("bytes"))
            roll = Rolling(byte_codes(data))
            asked = batch.column("asked")
            per_row = np.diff(asked.offsets.to_numpy())
            parts = asked.flatten()
            low, high, n = (parts.field(c).to_numpy().astype(np.int64) for c in ("low", "high", "n"))
            count = high - low + 1
            row = np.repeat(np.repeat(np.arange(len(per_row)), per_row), count)
            place = ranges(low, count)
            start = at[:-1][row] + place
            columns = {c: batch.column(c).take(pa.array(row)) for c in ("anchor", "content")}
            columns |= {"n": pa.array(np.repeat(n, count)), "low": pa.array(place.astype(np.int32))}
            columns["window"] = signed(roll.spans(start, start + least))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return work

    return per_task(make)


def _repeats_of_large(segments: DataFrame, least: int) -> DataFrame:
    """Runs of repeated windows of different segments, of which an anchor has very many: anchor, content, low, high."""
    stretches = keep(
        segments.select("anchor", "content", "n", "windows", "lead", "bytes").mapInArrow(
            _stretches(least, min(STRETCH, least)),
            "anchor long, content long, n long, low int, high int, near int, far int, turn int, core long, bytes long",
        ),
        "stretches",
    )
    around = ["anchor", "turn", "core"]
    equal = [*around, "near", "far", "bytes"]
    kinds = keep(
        stretches.groupBy(*equal).agg(F.sum("n").alias("n"), F.first(F.struct("content", "low", "high")).alias("one")),
        "stretch-kinds",
    )
    known = stretches.where("n = 1").join(kinds.where("n > 1").select(*equal), equal, "left_semi")
    # Repeated kinds are needed too: windows of others may be equal to some of theirs.
    unclear = kinds.groupBy(*around).agg(F.count("*").alias("kinds"), F.min("n").alias("fewest"))
    asked = (
        kinds.join(unclear.where("kinds > 1 and fewest = 1"), around, "left_semi")
        .groupBy("anchor", F.col("one.content").alias("content"))
        .agg(F.collect_list(F.struct("n", "one.low", "one.high")).alias("asked"))  # of one segment
    )
    windows = keep(
        segments.join(asked, ["anchor", "content"])
        .select("anchor", "content", "bytes", "asked")
        .mapInArrow(_windows(least), "anchor long, content long, n long, low int, window long"),
        "windows",
    )
    common = windows.groupBy("anchor", "window").agg(F.sum("n").alias("all")).where("`all` > 1").select("anchor", "window")
    spread = windows.where("n = 1").join(common, ["anchor", "window"], "left_semi")
    return known.select("anchor", "content", "low", "high").union(spread.selectExpr("anchor", "content", "low", "low as high"))


def repeats(docs: DataFrame, least: int = LEAST, gram: int = GRAM, group: int = GROUP, transform: int = TRANSFORM) -> DataFrame:
    """Runs of repeated windows of keyed rows: key, mark, start and end in bytes. They may touch or overlap."""
    found = keep(segments(docs, least, gram), "segments")
    kinds = found.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("key", "mark", "place", "windows", "lead"))
    )
    kinds = keep(kinds, "segment-kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    asked = keep(
        kinds.join(several, "anchor")
        .withColumn("asked", F.struct("anchor", "content", "n", "place", "windows", "lead"))
        .groupBy("key", "mark")
        .agg(F.collect_list("asked").alias("asked")),  # of one text
        "segments-asked",
    )
    # Of rows that are equal, any one does.
    texts = docs.join(asked, ["key", "mark"]).select("key", "mark", "text", "asked").dropDuplicates(["key", "mark"])
    fetched = keep(
        texts.select("text", "asked").mapInArrow(
            _fetch(least), "anchor long, content long, n long, windows int, lead int, bytes binary"
        ),
        "segment-texts",
    )
    large = keep(several.where(F.col("kinds") > group).select("anchor"), "large-anchors")
    any_large = bool(large.head(1))  # mostly there is none, and the plan has no part for them
    small = (
        (fetched.join(large, "anchor", "left_anti") if any_large else fetched)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_expand(least, transform), "anchor long, content long, low int, high int")
    )
    whole = kinds.where("n > 1").selectExpr("anchor", "content", "0 as low", "windows - 1 as high")
    known = small.unionByName(whole)
    if any_large:
        known = known.unionByName(_repeats_of_large(fetched.join(large, "anchor", "left_semi"), least))
    return found.join(known, ["anchor", "content"]).select(
        "key", "mark", (F.col("place") + F.col("low")).alias("start"), (F.col("place") + F.col("high") + least).alias("end")
    )


def _cut(with_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def make():
        def work(batch):
            data, at = flat_bytes(batch.column("text"))
            rows = []
            for i, (doc, spans) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("spans").to_pylist())):
                text = data[at[i] : at[i + 1]]
                gone = np.zeros(len(text), bool)
                for span in spans:
                    gone[span["start"] : span["end"]] = True
                kept = (text[~gone] if spans else text).tobytes()
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[:1].sum())
                rows.append((doc, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)[: len(names)])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        return work

    return per_task(make)


def remove_repeats(docs: DataFrame, least: int = LEAST, with_text: bool = False, **options) -> DataFrame:
    """One row per document: how many bytes and runs go, and a digest of what stays.

    A byte goes if a string of ``least`` bytes that covers it also starts elsewhere in ``docs``, judged on the
    input. ``with_text`` adds the remaining bytes as ``kept`` (they may cut characters of several bytes).
    """
    rows = keyed(docs)
    spans = repeats(rows, least, **options).groupBy("key", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    joined = rows.join(spans, ["key", "mark"], "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return joined.mapInArrow(_cut(with_text), schema)


def _strip(batch: pa.RecordBatch) -> pa.Array:
    """Texts of a batch without their spans; what is left of a character that was cut goes too."""
    data, at = flat_bytes(batch.column("text"))
    out = []
    for i, spans in enumerate(batch.column("spans").to_pylist()):
        text, done = data[at[i] : at[i + 1]].tobytes(), 0
        parts = []
        for start, end in sorted((s["start"], s["end"]) for s in spans):
            parts.append(text[done : max(done, start)])
            done = max(done, end)
        out.append(b"".join([*parts, text[done:]]).decode("utf-8", "ignore"))
    return pa.array(out, pa.string())


def without_repeats(docs: DataFrame, least: int = LEAST, **options) -> DataFrame:
    """``docs`` (any columns, with doc_id and text) with shorter texts; rows that lose nothing are unchanged.

    Where there is a column n_chars, it is counted anew for the texts that changed.
    """
    spans = repeats(keyed(docs), least, **options).groupBy("key", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    )
    joined = rows.join(spans, ["key", "mark"], "left").select("row", F.col("row.text").alias("text"), "spans")
    changed = joined.where("spans is not null").mapInArrow(
        per_task(
            lambda: lambda batch: [pa.RecordBatch.from_arrays([batch.column("row"), _strip(batch)], names=["row", "text"])]
        ),
        T.StructType([joined.schema["row"], joined.schema["text"]]),
    )
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    kept = [new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns]
    return joined.where("spans is null").select("row.*").union(changed.select(*kept))
