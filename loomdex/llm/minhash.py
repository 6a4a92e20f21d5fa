"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. A shingle (five words, A-Z folded) weighs its count in the text times its inverse document frequency.
   Frequencies count all documents, in a table of hashed cells whose size is fixed: a shingle's share of the
   documents is its cell's count, less what other shingles add on average, over the number of documents.
   Shares below ``RARE`` count as ``RARE``, which is what the table resolves at any size of the corpus. The
   weight runs from 1 (in every document) to 1 + ``SPAN`` (rare): with a wider span, the few rare shingles of an
   edit outweigh all that the copies of a large group have in common, and near copies are lost.
2. Each different text gets ``BANDS`` x ``ROWS`` consistent weighted samples; samples are hashed by band. A pair
   with similarity 0.8 shares no band with probability (1 - 0.8^2)^12 = 5e-6.
3. A band's bucket with few texts is joined into pairs. A middle one is one block of a task, which verifies likely
   pairs until all that is near is connected. One above ``LARGE`` is first split by the next bands; where even that
   is above ``LARGE``, it is dealt at random, otherwise in each bucket, into blocks with one common text.
4. Such a split misses pairs, so the texts of all buckets above ``LARGE`` are then joined on their rarest shingles:
   of a pair at the threshold, the lighter text's rarest (1 - t) / (1 + t) of its weight and the heavier one's rarest
   1 - t share a shingle; how far into the latter depends on the ratio of their weights. All pairs of such a shingle that are not connected yet are compared, many of them as a grid
   of blocks. That is the square of a group only where its texts are at the threshold to each other but apart.
5. Pairs are verified by the weighted Jaccard similarity of their whole texts, and linked texts form classes.

Equal word sequences are one text from the start. Null, empty and wordless texts are classes of their own. Null
ids are kept; a class is named by its smallest id. Repeated rows are copies. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import U, blocks, keep, mix, per_task, ranges, signed, texts_of
from loomdex.llm.components import components
from loomdex.llm.words import CODE, hashed_words, same_row, shingles

THRESHOLD = 0.8
BANDS, ROWS = 12, 2
CELLS, PARTS = 1 << 21, 64
RARE = 1 / 2048
SPAN = 0.25
#: Texts of a bucket that are compared pairwise.
SMALL = 12
#: Bands by which a too large bucket of a band is split first.
NEXT = 3
#: Texts of a bucket that one task compares.
LARGE = 500
#: Texts, and bytes of them, that a block of the grid over a frequent shingle takes.
GRID, GRID_BYTES = 1_600, 8 << 20
#: Share of equal samples from which a pair is verified; at similarity 0.8, 1 pair in 20,000 is below it.
LIKELY = 10 / 24
LINK = "u long, v long, similarity double"


def _cell(code: np.ndarray) -> np.ndarray:
    return (code & U(CELLS - 1)).astype(np.int64)


def _count_cells(batches):
    """Document frequencies of a task's texts, one row per part of the table."""
    cells = np.zeros(CELLS, np.int32)
    for batch in batches:
        for _, _, data, at in blocks(batch):
            words, _, _, first = hashed_words(data, at)
            cells += np.bincount(_cell(shingles(words, first)[1]), minlength=CELLS).astype(np.int32)
    for k, part in enumerate(cells.reshape(PARTS, -1)):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], names=["part", "cells"])


def _add_cells(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(*(c.to_pylist() for c in batch.columns)):
            found = np.frombuffer(zlib.decompress(cells), np.int32)
            sums[part] = sums[part] + found if part in sums else found.astype(np.int64)
    for part, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()])], names=["part", "cells"])


def cell_counts(texts: DataFrame) -> np.ndarray:
    """How many texts have a shingle of each cell. The table has a fixed size and may be sent to every task."""
    schema = "part int, cells binary"
    summed = texts.select("text").mapInArrow(_count_cells, schema).repartition(PARTS, "part").mapInArrow(_add_cells, schema)
    cells = np.zeros((PARTS, CELLS // PARTS))
    for row in summed.collect():  # PARTS rows of one fixed size
        cells[row.part] = np.frombuffer(row.cells, np.int64)
    return cells.ravel()


def inverse_frequencies(texts: DataFrame, documents: int) -> np.ndarray:
    """Weight of each cell, from all texts."""
    cells = cell_counts(texts)
    noise = (cells.sum() - cells) / (CELLS - 1)
    share = np.clip((cells - noise) / max(documents, 1), RARE, 1)
    return (1 + SPAN * np.log(share) / np.log(RARE)).astype(np.float32)


def _quantiles() -> np.ndarray:
    """Gamma(2, 1) at 65,536 evenly spaced probabilities."""
    x = np.linspace(0, 40, 400_001)
    return np.interp((np.arange(1 << 16) + 0.5) / (1 << 16), 1 - (1 + x) * np.exp(-x), x).astype(np.float32)


def weighted_samples(code: np.ndarray, weight: np.ndarray, start: np.ndarray, samples: int) -> np.ndarray:
    """Consistent samples of weighted sets: [sample, set] codes of the chosen element and its step.

    ``start`` are the places where sets begin; none is empty.
    """
    gamma = _quantiles()
    log_gamma = np.log(gamma)
    log_weight = np.log(weight).astype(np.float32)
    size = np.diff(np.r_[start, len(code)])
    out = np.empty((samples, len(start)), U)
    for k in range(samples):
        bits = mix(code * U(2 * k + 1) + U(0x632BE59BD9B4E019 * (k + 1) % 2**64))
        r = gamma[(bits & U(0xFFFF)).astype(np.int64)]
        c = log_gamma[((bits >> U(16)) & U(0xFFFF)).astype(np.int64)]
        beta = ((bits >> U(32)) & U(0xFFFFFF)).astype(np.float32) * np.float32(2**-24)
        step = np.floor(log_weight / r + beta)
        value = c - r * (step - beta + 1)
        least = np.minimum.reduceat(value, start)
        hit = np.flatnonzero(value == np.repeat(least, size))
        chosen = hit[np.searchsorted(hit, start)]
        out[k] = mix(code[chosen] ^ (step[chosen].astype(np.int64).view(U) << U(CODE)))
    return out


def _sign(weights):
    def make():
        cells = weights.value

        def work(batch):
            doc_ids = batch.select(["key", "mark"])
            for row, end, data, at in blocks(batch):
                words, _, _, first = hashed_words(data, at)
                text, code, often, whole = shingles(words, first)
                filled = np.flatnonzero(np.diff(first) > 0)
                bands, drawn = np.zeros((end - row, BANDS), U), np.zeros((end - row, BANDS * ROWS), U)
                if len(filled):
                    start = np.searchsorted(text, filled)
                    samples = weighted_samples(code, often * cells[_cell(code)], start, BANDS * ROWS)
                    both = mix(samples[0::2] * U(3) ^ mix(samples[1::2]))
                    bands[filled], drawn[filled] = both.T, samples.T
                n = np.diff(first)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), signed(x.ravel()))
                    for x in (drawn, bands)
                ]
                own = doc_ids.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, signed(whole), pa.array(n.astype(np.int64)), *lists], names=["key", "mark", "node", "words", "samples", "bands"]
                )

        return work

    return per_task(make)


def similarities(sides: list, weights: np.ndarray, pairs: int) -> np.ndarray:
    """Weighted Jaccard similarity of each pair; sides are (text, code, often) of the two texts of each pair."""
    keys = [(t.astype(U) << U(CODE)) | c for t, c, _ in sides]
    weight = [n * weights[_cell(c)].astype(np.float64) for _, c, n in sides]
    _, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
    common = np.bincount(sides[0][0][i], np.minimum(weight[0][i], weight[1][j]), minlength=pairs)
    total = sum(np.bincount(s[0], w, minlength=pairs) for s, w in zip(sides, weight))
    return common / np.maximum(total - common, 1e-300)


def _verify(weights, threshold: float):
    def make():
        cells = weights.value

        def work(batch):
            for row, end, data, at in blocks(batch, "text_u"):
                other = next(blocks(batch.slice(row, end - row), "text_v", 1 << 40))
                sides = [shingles(w, f)[:3] for w, _, _, f in (hashed_words(data, at), hashed_words(other[2], other[3]))]
                found = similarities(sides, cells, end - row)
                good = pa.array(np.flatnonzero(found >= threshold))
                own = batch.slice(row, end - row)
                columns = [own.column(c).take(good) for c in ("u", "v")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found).take(good)], names=["u", "v", "similarity"])

        return work

    return per_task(make)


def _cluster(weights, threshold: float):
    """Links that connect each group of texts of one block: all likely pairs are verified unless connected already.

    Texts with one ``root`` are connected from the start.
    """

    def solve(cells, node, root, samples, texts):
        n = len(node)
        data = np.frombuffer(b"".join(texts), np.uint8)
        at = np.r_[0, np.cumsum([len(t) for t in texts])]
        words, _, _, first = hashed_words(data, at)
        text, code, often, _ = shingles(words, first)
        begin, size = np.searchsorted(text, np.arange(n)), np.bincount(text, minlength=n)
        alike = np.zeros((n, n), np.int8)
        for k in range(samples.shape[1]):
            alike += samples[:, k, None] == samples[None, :, k]
        root = np.unique(root, return_inverse=True)[1]
        i, j = np.nonzero(np.triu((alike >= LIKELY * samples.shape[1]) & (root[:, None] != root), 1))
        order = np.argsort(-alike[i, j], kind="stable")
        i, j = i[order], j[order]
        links = []
        while len(i):
            part = slice(0, 1000)
            sides = [
                (np.repeat(np.arange(len(x)), size[x]), code[places := ranges(begin[x], size[x])], often[places]) for x in (i[part], j[part])
            ]
            found = similarities(sides, cells, len(i[part]))
            for a, b, s in zip(i[part].tolist(), j[part].tolist(), found.tolist()):
                if s >= threshold and root[a] != root[b]:
                    root[root == root[b]] = root[a]
                    links.append((node[a], node[b], s))
            i, j = i[1000:], j[1000:]
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
        return links

    def run(batches):
        cells = weights.value
        held: list = []
        group = None
        for batch in batches:
            samples = batch.column("samples")
            flat = samples.flatten().to_numpy().reshape(len(samples), -1)
            lists = (batch.column(c).to_pylist() for c in ("bucket", "block", "node", "root", "text"))
            for bucket, block, node, root, text, own in zip(*lists, flat):
                if (bucket, block) != group:
                    if len(held) > 1:
                        yield from _emit(solve(cells, *_columns(held)))
                    group, held = (bucket, block), []
                held.append((node, root, own, text.encode()))
        if len(held) > 1:
            yield from _emit(solve(cells, *_columns(held)))

    return run


def _columns(held: list) -> tuple:
    node, root, samples, texts = zip(*held)
    return node, np.array(root), np.array(samples), texts


def _emit(links: list):
    if links:
        u, v, s = zip(*links)
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s)], names=["u", "v", "similarity"])


def _sized(members: DataFrame) -> DataFrame:
    size = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("node").alias("leader")).where("size > 1")
    return members.join(size, "bucket")


def _pairs(members: DataFrame) -> DataFrame:
    """All pairs of small buckets (bucket, node)."""
    return members.alias("a").join(members.alias("b"), F.expr("a.bucket = b.bucket and a.node < b.node")).selectExpr("a.node as u", "b.node as v")


def _verified(pairs: DataFrame, node_texts: DataFrame, weights, threshold: float) -> DataFrame:
    sides = [node_texts.withColumnsRenamed({"node": x, "text": f"text_{x}"}) for x in ("u", "v")]
    return pairs.join(sides[1], "v").join(sides[0], "u").mapInArrow(_verify(weights, threshold), LINK)


def _clustered(blocks_of: DataFrame, nodes: DataFrame, node_texts: DataFrame, weights, threshold: float) -> DataFrame:
    """Links within each block (bucket, block, node, root)."""
    return (
        blocks_of.join(nodes.select("node", "samples"), "node").join(node_texts, "node")
        .select("bucket", "block", "node", "root", "samples", "text")
        .repartition("bucket", "block").sortWithinPartitions("bucket", "block")
        .mapInArrow(_cluster(weights, threshold), LINK)
    )


def _rarest(weights, counts, threshold: float):
    """Postings of the rarest shingles of each text, by ``counts``: a share 1 - t of its weight, and in it the share for the lighter of two."""

    def make():
        cells, seen = weights.value, counts.value

        def work(batch):
            own = batch.select(["node", "root"])
            for row, end, data, at in blocks(batch):
                words, _, _, first = hashed_words(data, at)
                text, code, often, _ = shingles(words, first)
                order = np.lexsort((code, seen[_cell(code)], text))  # any order that is the same for all texts is right
                code, weight = code[order], (often * cells[_cell(code)].astype(np.float64))[order]
                total = np.bincount(text, weight, minlength=end - row)
                before = np.cumsum(weight) - weight
                share = (before - before[np.searchsorted(text, text)]) / total[text] - 1e-6
                taken = np.flatnonzero(share <= 1 - threshold)
                light = share[taken] <= (1 - threshold) / (1 + threshold)
                of = own.slice(row, end - row).take(pa.array(text[taken]))
                # Of a pair at the threshold, the lighter text has at most this weight if the heavier one's first common shingle is here.
                reach = total[text[taken]] * ((1 - share[taken]) * (1 + threshold) / threshold - 1 + 1e-6)
                columns = [signed(code[taken]), *of.columns, pa.array(light), pa.array(total[text[taken]]), pa.array(reach), pa.array(np.diff(at)[text[taken]])]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "node", "root", "light", "weight", "reach", "bytes"])

        return work

    return per_task(make)


def crowded_links(crowded: DataFrame, nodes: DataFrame, node_texts: DataFrame, weights, threshold: float) -> DataFrame:
    """Verified links that connect what is near among ``crowded`` (node, root) and does not share a root."""
    texts = node_texts.join(crowded, "node")
    counts = crowded.sparkSession.sparkContext.broadcast(cell_counts(texts).astype(np.float32))
    schema = "bucket long, node long, root long, light boolean, weight double, reach double, bytes long"
    postings = keep(texts.select("node", "root", "text").mapInArrow(_rarest(weights, counts, threshold), schema), "rarest")
    lightest = postings.where("light").groupBy("bucket").agg(F.min("weight").alias("lightest"))
    postings = keep(postings.join(lightest, "bucket").where("light or lightest <= reach").drop("lightest", "reach"), "rarest")
    by_root = postings.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.count_if("light").alias("light"), F.sum("bytes").alias("bytes"))
    size = by_root.groupBy("bucket").agg(
        F.sum("n").alias("size"), F.sum("light").alias("lights"), F.max("n").alias("most"), F.max_by("root", "n").alias("main"),
        F.ceil(F.sum("bytes") / F.sum("n")).alias("mean"),
    )
    # Of a pair to compare, one is light here, and one is outside of the main root: the fewer of both are one side.
    sides = size.where("most < size and lights > 0").select(
        "bucket", "size", "main", "mean", (F.col("lights") <= F.col("size") - F.col("most")).alias("by_light"), F.least("lights", F.expr("size - most")).alias("few")
    )
    met = keep(postings.join(sides, "bucket"), "rarest", narrow=True)
    small = F.col("few") * F.col("size") <= SMALL**2
    a, b = met.where(small & F.col("light")).alias("a"), met.where(small).alias("b")
    near = f"a.weight <= b.weight and a.weight >= {threshold - 1e-6} * b.weight"
    pairs = a.join(b, F.expr(f"a.bucket = b.bucket and a.root <> b.root and {near}")).selectExpr("least(a.node, b.node) as u", "greatest(a.node, b.node) as v")

    # A block's texts are bounded in number and in bytes, as far as the list's mean tells; longer ones are few in each block.
    half = F.greatest(F.least(F.lit(GRID // 2), F.floor(F.lit(GRID_BYTES // 2) / F.col("mean"))), F.lit(1))
    down, across = F.ceil(F.col("few") / half), F.ceil(F.col("size") / half)
    place = F.xxhash64("node", "bucket")
    one_side = F.when(F.col("by_light"), F.col("light")).otherwise(F.col("root") != F.col("main"))
    grid = met.where(~small).withColumns({"down": down, "across": across})
    first = grid.where(one_side).withColumn("i", F.pmod(place, "down")).select("*", F.explode(F.expr("sequence(0L, across - 1)")).alias("j"))
    second = grid.withColumn("j", F.pmod(place, "across")).select("*", F.explode(F.expr("sequence(0L, down - 1)")).alias("i"))
    cells = first.unionByName(second).select("bucket", F.expr("i * across + j").alias("block"), "node", "root")
    return _verified(pairs.distinct(), node_texts, weights, threshold).union(_clustered(cells, nodes, node_texts, weights, threshold))


def connected(nodes: DataFrame, node_texts: DataFrame, weights, threshold: float) -> DataFrame:
    """Rows (node, root) of the nodes (node, samples, bands) that are near to another."""
    banded = nodes.select("node", F.posexplode("bands").alias("i", "x"))
    one = keep(_sized(banded.select("i", F.xxhash64("i", "x").alias("bucket"), "node")), "buckets", narrow=True)
    size = F.col("size")
    again = one.where(size > LARGE).select("i", "bucket", "node").join(nodes.select("node", F.posexplode("bands").alias("j", "y")), "node")
    two = keep(_sized(again.where(F.pmod(F.col("j") - F.col("i"), F.lit(BANDS)).between(1, NEXT)).select("i", F.xxhash64("bucket", "j", "y").alias("bucket"), "node")), "buckets", narrow=True)
    pairs = _pairs(one.where(size <= SMALL)).union(_pairs(two.where(size <= SMALL))).distinct()
    # Middle buckets are one block each. Above that, and alike in two bands, random blocks; the leader is in all.
    dealt = F.pmod(F.xxhash64("node", "bucket"), F.ceil(size / LARGE)).cast("int")
    over = two.where(size > LARGE)
    leaders = over.where("node = leader").select("bucket", "node", F.explode(F.sequence(F.lit(0), (F.ceil(size / LARGE) - 1).cast("int"))).alias("block"))
    blocks_of = (
        one.union(two).where((size > SMALL) & (size <= LARGE)).select("bucket", "node", F.lit(0).alias("block"))
        .union(over.where("node <> leader").select("bucket", "node", dealt.alias("block")))
        .union(leaders)
    ).withColumn("root", F.col("node"))
    links = _verified(pairs, node_texts, weights, threshold).union(_clustered(blocks_of, nodes, node_texts, weights, threshold))
    roots = components(links.select("u", "v"))
    crowded = one.where(size > LARGE).select("node").distinct()
    if crowded.isEmpty():
        return roots
    roots = keep(roots, "roots", narrow=True)
    crowded = keep(crowded.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "crowded", narrow=True)
    more = crowded_links(crowded, nodes, node_texts, weights, threshold)
    return components(roots.selectExpr("node as u", "root as v").union(more.select("u", "v")))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, is_first, key, mark.

    ``key`` and ``mark`` tell rows apart: equal rows share them. ``is_first`` marks the rows of each class that
    equal its row with the smallest id; of several texts under that id, one is taken.
    """
    spark = docs.sparkSession
    texts = texts_of(docs).select(*same_row(), "text")
    weights = spark.sparkContext.broadcast(inverse_frequencies(texts, texts.count()))
    signed_rows = keep(
        texts.mapInArrow(_sign(weights), "key long, mark long, node long, words long, samples array<long>, bands array<long>"), "signatures"
    )
    filled = signed_rows.where("words > 0")
    nodes = keep(filled.groupBy("node").agg(*(F.first(c).alias(c) for c in ("key", "mark", "samples", "bands"))), "nodes")
    bands = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    shared = bands.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1").select("band", "value")
    met = nodes.join(bands.join(shared, ["band", "value"], "left_semi").select("node").distinct(), "node", "left_semi")
    of_node = texts.join(met.select("key", "mark", "node"), ["key", "mark"]).dropDuplicates(["node"]).select("node", "text")
    node_texts = keep(of_node, "node-texts")

    roots = connected(nodes.join(met.select("node"), "node", "left_semi"), node_texts, weights, threshold)
    # A text without words stands alone: its row is its class.
    own = F.when(F.col("words") > 0, F.col("node")).otherwise(F.xxhash64("key", "mark", F.monotonically_increasing_id()))
    rows = signed_rows.select("key", "mark", "node", "words").join(roots, "node", "left")
    rows = keep(rows.select("key", "mark", F.coalesce("root", own).alias("root")), "classes")
    none = F.lit(-(2**63))
    order = F.struct((F.col("key") == none).alias("unnamed"), "key", "mark")  # rows without an id come last
    classes = rows.groupBy("root").agg(
        F.count("*").alias("class_size"),
        F.min(F.when(F.col("key") != none, F.col("key"))).alias("class_id"),
        F.min(order).alias("head"),
    )
    return rows.join(classes, "root").select(
        F.when(F.col("key") != none, F.col("key")).alias("doc_id"), "class_id", "class_size",
        (order == F.col("head")).alias("is_first"), "key", "mark",
    )


def first_of_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (any columns) that come first in their class; of equal rows, one."""
    heads = near_duplicates(docs, threshold).where("is_first").select("key", "mark").distinct()
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
    )
    return rows.join(heads, ["key", "mark"]).dropDuplicates(["key", "mark"]).select("row.*")
