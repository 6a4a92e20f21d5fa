"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the different words, stems (the first bytes of a word, which words of one family
share), pairs of neighbouring words and pairs with one or two words between, hashed to ``CELLS`` cells. Training
walks over a bounded sample of labelled rows (``SAMPLE``, a documented parameter; drawn by hash of the id)
with a rate for each coordinate and L1 sparsity, so few weights stay and are sent to all tasks. Scoring reads
every whole text once, in one stage without a shuffle.

Null texts count as empty; an empty text gets the score of the bias alone. Labels that are null are left
out; repeated label rows count each. Without labels, or with an empty table, all weights are 0 and the score is
the bias'. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.llm.common import U, blocks, byte_codes, mix, per_task, texts_of, Rolling
from loomdex.llm.words import FOLD, hashed_words

CELLS = 1 << 20
SAMPLE = 8_000
STEMS = (4, 5, 6)
RATE, SMOOTH, L1, L2, EPOCHS = 1.0, 1.0, 4.0, 0.1, 6
THRESHOLD = 0.3


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and cell of each feature of a block; features may repeat."""
    words, start, end, first = hashed_words(data, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    roll = Rolling(byte_codes(FOLD[data]))
    found = [(text, words)]
    for k in STEMS:
        long = np.flatnonzero(end - start > k)
        found.append((text[long], roll.spans(start[long], start[long] + k) + U(k)))
    for gap in (1, 2, 3):
        inside = np.flatnonzero(text[gap:] == text[:-gap]) if len(text) > gap else np.zeros(0, np.int64)
        found.append((text[inside], mix(words[inside] * U(2 * gap + 1) ^ words[inside + gap])))
    return np.concatenate([t for t, _ in found]), np.concatenate([(h >> U(44)).astype(np.int64) for _, h in found])


def _featured(batches):
    for batch in batches:
        for row, end, data, at in blocks(batch):
            text, cell = features(data, at)
            both = np.unique(text * CELLS + cell)
            counts = np.bincount(both // CELLS, minlength=end - row)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array((both % CELLS).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(row, end - row), lists], names=["label", "cells"])


def train(rows: list[tuple[int, np.ndarray]], epochs: int = EPOCHS, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and bias from (label, different cells) of each text."""
    z, n = np.zeros(CELLS), np.zeros(CELLS)
    bias, seen = 0.0, 0.0
    rng = np.random.default_rng(seed)

    def weight(z, n):
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((SMOOTH + np.sqrt(n)) / RATE + L2), 0.0)

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            label, cells = rows[i]
            zi, ni = z[cells], n[cells]
            w = weight(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / RATE
            z[cells] = zi + g - sigma * w
            n[cells] = ni + g * g
            seen += g * g
            bias -= RATE * g / (SMOOTH + np.sqrt(seen))
    return weight(z, n), bias


def _train(batches):
    rows = []
    for batch in batches:
        cells = batch.column("cells")
        at, flat = cells.offsets.to_numpy(), cells.values.to_numpy()
        rows += [(y, flat[a:b].copy()) for y, a, b in zip(batch.column("label").to_pylist(), at[:-1], at[1:])]
    weights, bias = train(rows)
    used = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[used, -1].astype(np.int32)), pa.array(np.r_[weights[used], bias])], names=["cell", "weight"]
    )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Cells, weights and bias, from ``labels`` (doc_id, label) of ``docs``. Which rows may teach is the caller's choice."""
    drawn = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    rows = texts_of(docs).join(F.broadcast(drawn), "doc_id").select("label", "text")  # at most ``sample`` rows
    model = rows.mapInArrow(_featured, "label int, cells array<int>").repartition(1).mapInArrow(_train, "cell int, weight double").toPandas()
    bias = model.weight[model.cell == -1]
    model = model[model.cell >= 0]
    return model.cell.to_numpy(), model.weight.to_numpy(), float(bias.iloc[0]) if len(bias) else 0.0


def _score(model):
    def make():
        cells, values, bias = model.value
        weights = np.zeros(CELLS)
        weights[cells] = values

        def work(batch):
            for row, end, data, at in blocks(batch):
                text, cell = features(data, at)
                used = np.flatnonzero(weights[cell])
                both = np.unique(text[used] * CELLS + cell[used])
                total = np.bincount(both // CELLS, weights[both % CELLS], minlength=end - row) + bias
                scores = pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))
                own = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in own.schema.names if c != "text"), scores],
                    names=[*(c for c in own.schema.names if c != "text"), "score"],
                )

        return work

    return per_task(make)


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id and score (0 to 1, higher: toxic likelier) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most CELLS weights
    return texts_of(docs).mapInArrow(_score(sent), "doc_id long, score double")


def scored_rows(docs: DataFrame, model) -> DataFrame:
    """Every row of ``docs`` (any columns) as ``row``, with its score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_score(sent), T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n: tells the folds apart (a null id has none)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n
