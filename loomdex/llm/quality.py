"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text's terms are its words and pairs of neighbouring words (hashed to ``CELLS`` columns each) and how it is written, in any
language: triples of byte classes (lower, upper, digit, space, kinds of punctuation), word lengths, and how often words and pairs
of words repeat. Square roots of their shares, weighted by inverse document frequency, are projected on the leading singular
vectors of a bounded sample of labelled rows (``SAMPLE``, a documented parameter; drawn by hash of the id), centred and scaled to
length 1. ``WORDS`` says how much words and pairs weigh beside the form. The sample's vectors go to every task; each document is compared with all of
them by exact blocked products, and its ``NEIGHBOURS`` nearest vote, weighted by similarity. Whole texts are
read once, in one stage without a shuffle.

Null texts count as empty; an empty text, whose vector is that of no terms, is scored like any other. Null labels are left out.
Without labels the score is 0.5. Repeated rows are scored each; ties among neighbours go to the earlier one in the sample;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomdex.llm.common import blocks, mix, per_task, texts_of
from loomdex.llm.words import SOLID, WORD, hashed_words

SAMPLE = 4_000
DIMENSIONS, NEIGHBOURS = 32, 25
SHARPNESS = 8.0
THRESHOLD = 0.3
KINDS = 16
TRIPLES = KINDS**3
#: Further terms: 16 word lengths, repeats of words and pairs.
FORM = TRIPLES + 16 + 4
#: Columns of hashed words, and of hashed pairs; they follow the terms of form.
CELLS = 2_048
TERMS = FORM + 2 * CELLS
WORDS = 0.25


def _kinds() -> np.ndarray:
    out = np.full(256, 15, np.uint16)
    for k, members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "", " ", "\n\r\t", ".", ",", "!?", "|", "#", "*", "%$&@", "()[]{}:;\"'-", "/\\_=<>+~^")):
        for c in members:
            out[ord(c)] = k
    out[128:] = 3
    return out


def terms(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Square roots of the shares of each term: [text, term]."""
    n = len(at) - 1
    kind = _kinds()[data]
    counts = np.zeros((n, TERMS), np.float32)
    text = np.repeat(np.arange(n), np.diff(at))
    if len(data) > 2:
        triple = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
        inside = text[2:] == text[:-2]
        cells = text[:-2][inside] * TRIPLES + triple[inside]
        found = np.bincount(cells, minlength=n * TRIPLES).reshape(n, TRIPLES)
        counts[:, :TRIPLES] = found / np.maximum(found.sum(axis=1), 1)[:, None]
    words, start, end, first = hashed_words(data, at, SOLID)
    of = np.repeat(np.arange(n), np.diff(first))
    total = np.maximum(np.diff(first), 1)
    length = np.bincount(of * 16 + np.minimum(end - start, 16) - 1, minlength=n * 16).reshape(n, 16)
    counts[:, TRIPLES : TRIPLES + 16] = length / total[:, None]
    for k, gap in enumerate((1, 2)):
        if len(words) > gap:
            same = (words[gap:] == words[:-gap]) & (of[gap:] == of[:-gap])
            counts[:, TRIPLES + 16 + k] = np.bincount(of[gap:][same], minlength=n) / total
    for k, gap in enumerate((0, 1)):
        if len(words) > gap:
            pair = words[gap:] * np.uint64(3 + gap) ^ words[: len(words) - gap]
            own = of[gap:]
            order = np.lexsort((pair, own))
            again = (pair[order][1:] == pair[order][:-1]) & (own[order][1:] == own[order][:-1])
            counts[:, TRIPLES + 18 + k] = np.bincount(own[order][1:][again], minlength=n) / total
    words, _, _, first = hashed_words(data, at, WORD)
    of = np.repeat(np.arange(n), np.diff(first))
    pairs = mix(words[1:] * np.uint64(3) ^ words[:-1])[of[1:] == of[:-1]]
    for k, (codes, own) in enumerate(((words, of), (pairs, of[1:][of[1:] == of[:-1]]))):
        found = np.bincount(own * CELLS + (codes % np.uint64(CELLS)).astype(np.int64), minlength=n * CELLS).reshape(n, CELLS)
        lo = FORM + k * CELLS
        counts[:, lo : lo + CELLS] = found * (WORDS**2 / np.maximum(found.sum(axis=1), 1))[:, None]
    return np.sqrt(counts)


def fit(rows: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> dict:
    """Projection, and the vectors and labels of the sample."""
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    _, _, right = np.linalg.svd(_sketch(rows, idf.astype(np.float32), dimensions), full_matrices=False)
    axes = (right[:dimensions].T * idf[:, None]).astype(np.float32)
    mean = (rows @ axes).mean(axis=0)
    model = {"axes": axes, "mean": mean, "labels": labels.astype(np.float64)}
    return model | {"vectors": project(rows, model)}


def _sketch(rows: np.ndarray, idf: np.ndarray, dimensions: int) -> np.ndarray:
    """A small matrix with the leading right singular vectors of ``rows * idf``, which is never made (random projection, four power rounds)."""
    basis = np.random.default_rng(11).standard_normal((rows.shape[1], dimensions + 10)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(idf[:, None] * (rows.T @ (rows @ (idf[:, None] * basis))))
    return np.linalg.svd(rows @ (idf[:, None] * basis), full_matrices=False)[2] @ basis.T


def project(rows: np.ndarray, model: dict) -> np.ndarray:
    out = rows @ model["axes"] - model["mean"]
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def nearest(near: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row; of equal ones the earlier."""
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    cut = np.take_along_axis(near, best, axis=1).min(axis=1, keepdims=True)
    crowded = np.flatnonzero((near >= cut).sum(axis=1) > k)
    if len(crowded):
        rows, cut = near[crowded], cut[crowded]
        above, tied = rows > cut, rows == cut
        room = k - above.sum(axis=1, keepdims=True)
        best[crowded] = np.nonzero(above | (tied & (np.cumsum(tied, axis=1) <= room)))[1].reshape(-1, k)
    return best


def vote(vectors: np.ndarray, model: dict, k: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> np.ndarray:
    known = model["vectors"]
    if not len(known):
        return np.full(len(vectors), 0.5)
    k = min(k, len(known))
    out = np.empty(len(vectors))
    for lo in range(0, len(vectors), 512):
        near = vectors[lo : lo + 512] @ known.T
        best = nearest(near, k)
        similarity = np.take_along_axis(near, best, axis=1).astype(np.float64)
        weight = np.exp(sharpness * (similarity - similarity.max(axis=1, keepdims=True)))
        out[lo : lo + 512] = (weight * model["labels"][best]).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0, 1)


def _described(batches):
    for batch in batches:
        for row, end, data, at in blocks(batch):
            for lo in range(0, end - row, 1000):
                hi = min(lo + 1000, end - row)
                rows = terms(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                for i in range(hi - lo):
                    used = np.flatnonzero(rows[i])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(row + lo + i, 1), batch.column("label").slice(row + lo + i, 1), pa.array([used.astype(np.int32)]), pa.array([rows[i, used]])],
                        names=["doc_id", "label", "terms", "shares"],
                    )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """A model from ``labels`` (doc_id, label) of ``docs``. Which rows may teach is the caller's choice."""
    drawn = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .where("doc_id is not null and label is not null")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample)
    )
    rows = texts_of(docs).join(F.broadcast(drawn), "doc_id").select("doc_id", "label", "text")  # at most ``sample`` rows
    schema = "doc_id long, label int, terms array<int>, shares array<float>"
    found = rows.mapInArrow(_described, schema).orderBy("doc_id", "label").toArrow()
    shares = np.zeros((found.num_rows, TERMS), np.float32)
    i = 0
    for batch in found.to_batches():
        for at, values in zip(batch.column("terms"), batch.column("shares")):
            shares[i, at.values.to_numpy()] = values.values.to_numpy()
            i += 1
    if not found.num_rows:
        return {"axes": np.zeros((TERMS, 1), np.float32), "mean": np.zeros(1), "labels": np.zeros(0), "vectors": np.zeros((0, 1))}
    return fit(shares, found.column("label").to_numpy())


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (0 to 1, higher: good quality likelier) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most SAMPLE vectors and TERMS axes

    def make():
        known = sent.value

        def work(batch):
            for row, end, data, at in blocks(batch):
                scores = np.empty(end - row)
                for lo in range(0, end - row, 1000):
                    hi = min(lo + 1000, end - row)
                    scores[lo:hi] = vote(project(terms(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]), known), known)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, end - row), pa.array(scores)], names=["doc_id", "score"])

        return work

    return texts_of(docs).mapInArrow(per_task(make), "doc_id long, score double")
