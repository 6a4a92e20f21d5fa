"""Benchmark decontamination by greedy string tiling.

Seeds are the hashes of ``LEAST`` consecutive words (A-Z folded). Those of all documents are joined to those of all
benchmark items. A pair whose shared seeds could cover enough of the item is tiled: running
Karp-Rabin looks for common word sequences from long to short, the longest that do not overlap are marked, and
this repeats down to ``LEAST`` words. The tiles' share of the item's words decides, so passages whose parts
were reordered are caught as well as whole ones.

Neither side passes through the driver. A sieve of fixed size (``SIEVE`` bits), gathered from the items' seeds, keeps what can't match
from being moved. A pair that covers the threshold shares at least threshold * words / LEAST of the item's seeds, so
it shares one of the rest of them too, whichever those are: pairs are looked for on an item's rarest seeds only, which keeps phrases that many items
and documents have out of the join. Equal texts are looked at once. Items meet a text in lists of up to ``ITEMS``.

Items with fewer than ``LEAST`` words, null or empty ones never match; nor do null or empty documents. Repeated rows of the
documents are judged each, of repeated rows of the items one counts; other columns pass through untouched. A text of many equal words costs
as much as its number of longest runs, one for each offset between the two, and not the product of both lengths.
One text and its item are held whole by a task.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomdex.llm.common import Rolling, U, blocks, flat_bytes, keep, per_task, ranges, signed
from loomdex.llm.words import hashed_words

LEAST = 5
THRESHOLD = 0.5
#: Items that meet a text at once.
ITEMS = 256
#: Two to this power are the bits of the sieve, which is broadcast.
SIEVE = 24
MATCH = "struct<item_id:long,n_tiles:int,n_covered:int,n_words:int,coverage:double>"


def _free(marked: np.ndarray, width: int) -> np.ndarray:
    """Places where ``width`` words in a row are unmarked."""
    sums = np.r_[0, np.cumsum(marked)]
    return sums[width:] == sums[:-width] if len(marked) >= width else np.zeros(0, bool)


class _Sequences:
    """Two sequences of word hashes: common runs of words that are not marked yet."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.words = a, b
        self.rolls = Rolling(a), Rolling(b)
        self.used = np.zeros(len(a), bool), np.zeros(len(b), bool)
        self.kinds = np.unique(np.r_[a, b], return_inverse=True)[1]

    def _before(self, side: int, at: np.ndarray) -> np.ndarray:
        """What stands before a place: the kind of word, or a value of the side's own where a run can't go on."""
        own = self.kinds[: len(self.words[0])] if side == 0 else self.kinds[len(self.words[0]) :]
        border = (at == 0) | self.used[side][at - 1]
        return np.where(border, side, own[at - 1] + 2)

    def _windows(self, width: int) -> list[np.ndarray]:
        """Hashes of the windows of each side."""
        return [roll.windows(width) for roll in self.rolls]

    def _lengths(self, i: np.ndarray, j: np.ndarray, width: int) -> np.ndarray:
        """Words of the common unmarked runs from each pair of places on, of which ``width`` are known, by halving steps."""
        size = np.full(len(i), width)
        for step in (1 << k for k in range(int(min(map(len, self.words))).bit_length() - 1, -1, -1)):
            (hash_a, hash_b), (free_a, free_b) = self._windows(step), (_free(u, step) for u in self.used)
            x, y = i + size, j + size
            on = np.flatnonzero((x < len(hash_a)) & (y < len(hash_b)))
            x, y = x[on], y[on]
            size[on[free_a[x] & free_b[y] & (hash_a[x] == hash_b[y])]] += step
        return size

    def common(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest unmarked common runs of at least ``width`` words: words, place in either.

        Places are paired by equal windows with different words before them, so a run is met at its start only.
        """
        hash_a, hash_b = self._windows(width)
        at_a, at_b = (np.flatnonzero(_free(u, width)) for u in self.used)
        kind = np.unique(np.r_[hash_a[at_a], hash_b[at_b]], return_inverse=True)[1].astype(np.int64)
        span = int(self.kinds.max(initial=0)) + 3
        key_a, group_b = kind[: len(at_a)] * span + self._before(0, at_a), kind[len(at_a) :] * span
        order = np.argsort(key_a, kind="stable")
        at_a, key_a, key_b = at_a[order], key_a[order], group_b + self._before(1, at_b)
        cuts = [np.searchsorted(key_a, *args) for args in ((group_b, "left"), (key_b, "left"), (key_b, "right"), (group_b + span, "left"))]
        before, after = cuts[1] - cuts[0], cuts[3] - cuts[2]
        i = at_a[np.r_[ranges(cuts[0], before), ranges(cuts[2], after)]]
        j = np.r_[np.repeat(at_b, before), np.repeat(at_b, after)]
        return self._lengths(i, j, width), i, j


def tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in text, words) of two sequences of word hashes."""
    if min(len(item), len(text)) < least:
        return []
    both = _Sequences(item, text)
    used_i, used_t = both.used
    out = []
    width = min(len(item), len(text))
    while True:
        size, at_i, at_t = both.common(width)
        longest = int(size.max(initial=0))
        if longest > 2 * width:
            width = longest
            continue
        queue = list(zip((-size).tolist(), at_i.tolist(), at_t.tolist()))
        heapq.heapify(queue)
        while queue:  # mark the longest; of what overlaps with marked words the free parts go back
            n, i, j = heapq.heappop(queue)
            taken = used_i[i : i - n] | used_t[j : j - n]
            if not taken.any():
                used_i[i : i - n] = used_t[j : j - n] = True
                out.append((i, j, -n))
                continue
            if taken.all():
                continue
            edges = np.flatnonzero(np.diff(np.r_[1, taken, 1]))
            for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
                if b - a >= width:
                    heapq.heappush(queue, (a - b, i + a, j + a))
        if width == least:
            return out
        width = max(least, width // 2)


def _words_of_items(batch: pa.RecordBatch):
    """Each item's words as packed hashes."""
    for row, end, data, at in blocks(batch):
        words, _, _, first = hashed_words(data, at)
        packed = [words[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
        own = batch.slice(row, end - row)
        yield pa.RecordBatch.from_arrays(
            [own.column("item"), own.column("item_id"), pa.array(packed, pa.binary()), pa.array(np.diff(first).astype(np.int32))],
            names=["item", "item_id", "words", "n"],
        )


def _seeds_of_items(batch: pa.RecordBatch):
    """Hash and place of each ``LEAST`` words of the items."""
    for row in range(batch.num_rows):
        words = np.frombuffer(batch.column("words")[row].as_buffer(), U)
        grams = Rolling(words).windows(LEAST)
        item = pa.repeat(batch.column("item")[row], len(grams))
        place = pa.array(np.arange(len(grams), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([item, signed(grams), place, pa.array(np.full(len(grams), len(words), np.int32))], names=["item", "hash", "place", "n"])


def _sieved(sent):
    """Different seeds of each text that the sieve lets through."""

    def make():
        sieve = np.unpackbits(sent.value.view(np.uint8), bitorder="little").view(bool)

        def work(batch):
            for row, end, data, at in blocks(batch):
                words, _, _, first = hashed_words(data, at)
                grams = Rolling(words).windows(LEAST)
                text = np.repeat(np.arange(end - row), np.diff(first))
                place = np.flatnonzero(sieve[(grams >> U(64 - SIEVE)).astype(np.int64)] & (text[LEAST - 1 :] == text[: len(grams)]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(row + text[place])), signed(grams[place])], names=["key", "hash"]
                )

        return work

    return per_task(make)


def _tile(threshold: float):
    """Tilings of a text with each item of its list."""
    kind = pa.struct([("item_id", pa.int64()), ("n_tiles", pa.int32()), ("n_covered", pa.int32()), ("n_words", pa.int32()), ("coverage", pa.float64())])

    def work(batch):
        for row in range(batch.num_rows):
            data, at = flat_bytes(batch.column("text").slice(row, 1))
            text = hashed_words(data, at)[0]
            found = []
            for item in batch.column("items")[row]:
                own = np.frombuffer(item["words"].as_buffer(), U)
                got = tiles(own, text)
                total = sum(t[2] for t in got)
                if total >= threshold * len(own):
                    found.append({"item_id": item["item_id"].as_py(), "n_tiles": len(got), "n_covered": total, "n_words": len(own), "coverage": total / len(own)})
            yield pa.RecordBatch.from_arrays([pa.repeat(batch.column("key")[row], len(found)), pa.array(found, kind)], names=["key", "match"])

    return per_task(lambda: work)


def _sieve_of(seeds: DataFrame) -> np.ndarray:
    """Bits of the leading digits of all seeds, in words of 64: of fixed size."""
    cell = F.shiftrightunsigned("hash", 64 - SIEVE)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - SIEVE}) & 63 as int))")
    rows = seeds.groupBy(F.shiftright(cell, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    sieve = np.zeros(1 << (SIEVE - 6), np.int64)
    sieve[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return sieve


def _candidates(hits: DataFrame, seeds: DataFrame, threshold: float) -> DataFrame:
    """Pairs (key, item) whose shared seeds cover the threshold of the item's words."""
    needed = F.greatest(F.lit(1), F.ceil(F.lit(threshold) * F.col("n") / LEAST))  # seeds that a match shares at least
    often = hits.groupBy("hash").agg(F.count(F.lit(1)).alias("texts"))
    by_rarity = Window.partitionBy("item").orderBy(F.coalesce("texts", F.lit(0)), "hash", "place")
    ranked = seeds.join(often, "hash", "left").withColumn("rank", F.row_number().over(by_rarity))
    rare = ranked.where(F.col("rank") <= F.col("n") - LEAST + 1 - needed + 1).where("texts is not null")
    near = hits.join(rare, "hash").groupBy("key", "item", "n").agg(F.count(F.lit(1)).alias("shared"))
    near = near.where(LEAST * (F.col("shared") + needed - 1) >= F.lit(threshold) * F.col("n")).select("key", "item")
    shared = near.join(seeds, "item").join(hits, ["key", "hash"], "left_semi")
    ahead = F.lead("place").over(Window.partitionBy("key", "item").orderBy("place")) - F.col("place")
    covered = shared.withColumn("adds", F.least(F.lit(LEAST), F.coalesce(ahead, F.lit(LEAST))))
    return covered.groupBy("key", "item", "n").agg(F.sum("adds").alias("covered")).where(F.col("covered") >= F.lit(threshold) * F.col("n"))


def _digest(*columns: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("\x1f", *columns).cast("binary")))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` (as ``row``) with the benchmark items (item_id, text) that it covers, as ``matches``, by item."""
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = items.select(_digest(F.col("item_id").cast("string"), F.col("text")).alias("item"), "item_id", "text")
    items = keep(items.mapInArrow(per_task(lambda: _words_of_items), "item binary, item_id long, words binary, n int").where(F.col("n") >= LEAST), "items")
    seeds = keep(items.select("item", "words").mapInArrow(per_task(lambda: _seeds_of_items), "item binary, hash long, place int, n int"), "item-seeds")
    sent = spark.sparkContext.broadcast(_sieve_of(seeds))
    own = F.coalesce("text", F.lit(""))
    texts = docs.select(_digest(own).alias("key"), own.alias("text"))
    hits = keep(texts.mapInArrow(_sieved(sent), "key binary, hash long").distinct(), "text-seeds", narrow=True)
    pairs = keep(_candidates(hits, seeds, threshold).select("key", "item"), "item-pairs", narrow=True)
    turn = F.row_number().over(Window.partitionBy("key").orderBy("item")) - 1
    lists = pairs.withColumn("turn", F.floor(turn / ITEMS)).join(items, "item").groupBy("key", "turn").agg(F.collect_list(F.struct("item_id", "words")).alias("items"))
    asked = texts.join(pairs.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.any_value("text").alias("text"))
    met = lists.join(asked, "key").select("key", "text", "items").mapInArrow(_tile(threshold), f"key binary, match {MATCH}")
    found = keep(met, "matches", narrow=True).groupBy("key").agg(F.array_sort(F.collect_list("match")).alias("matches"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), _digest(own).alias("key"))
    none = F.array().cast(f"array<{MATCH}>")
    return rows.join(found, "key", "left").select("row", F.coalesce("matches", none).alias("matches"))
