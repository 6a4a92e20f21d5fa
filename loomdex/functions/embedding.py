"""Text to dense vector: a built-in hashing embedder and a hook for a caller's model."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions.text import tokenize

DENSE_SIZE = 1024
VECTOR_TYPE = T.ArrayType(T.FloatType(), True)
PART_ELEMENTS = 1 << 19  # list elements of a batch that are worked on at a time
PART_CELLS = 1 << 20  # and cells of a dense matrix that is filled meanwhile


def _as_float_lists(matrix: np.ndarray) -> pa.Array:
    n, dim = matrix.shape
    offsets = pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32, copy=False).ravel()))


def _signed_buckets(words: list[str], dim: int) -> np.ndarray:
    """Signed bucket per word: of the first 32 bits of its md5 the lowest gives the sign and the
    rest, modulo ``dim``, the bucket 1..dim."""
    heads = [int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") for w in words]
    heads = np.array(heads, dtype=np.int64)
    return np.where(heads & 1, -1, 1) * ((heads >> 1) % dim + 1)


def _row_numbers(lists: pa.Array) -> np.ndarray:
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists), dtype=np.int64), sizes)


def list_parts(lists: pa.Array, rows: int | None = None, elements: int = PART_ELEMENTS) -> Iterator[tuple[int, int]]:
    """First and end row of runs of rows with so many rows and list elements at most; a longer row is a run of its own.

    What is made from a run is several times its size, so a worker's memory follows the runs and not the batch.
    """
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + elements, "right")))
        end = end if rows is None else min(end, start + max(rows, 1))
        yield start, end
        start = end


def hash_embedding(tokens: Column | str, dim: int = DENSE_SIZE) -> Column:
    """Deterministic embedding of a token array; no tokens give the zero vector.

    Works on large parts of Arrow batches: words are dictionary-encoded, so each distinct word of a part
    is hashed once, and the signed buckets are summed per row and scaled to length one.
    """

    def unit_sums(part: pa.Array) -> np.ndarray:
        words = part.flatten().dictionary_encode()
        signed = _signed_buckets(words.dictionary.to_pylist(), dim)
        signed = signed[words.indices.to_numpy(zero_copy_only=False)]
        slot = _row_numbers(part) * dim + np.abs(signed) - 1
        sums = np.bincount(slot, weights=np.sign(signed), minlength=len(part) * dim)
        matrix = sums.astype(np.float64, copy=False).reshape(len(part), dim)
        norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
        return np.divide(matrix, norms, out=matrix, where=norms > 0)

    @F.arrow_udf(VECTOR_TYPE)
    def embed(batch: pa.Array) -> pa.Array:
        out = np.empty((len(batch), dim), np.float32)
        for start, end in list_parts(batch, PART_CELLS // dim):
            out[start:end] = unit_sums(batch.slice(start, end - start))
        return _as_float_lists(out)

    return embed(tokens)


def vocabulary_weights(
    tokens: Column | str, names: Sequence[str], weights: Sequence[float]
) -> Column:
    """Dense weight array over a vocabulary: the weight where the row has the token, else 0.

    Tokens are looked up by hash for a large part of an Arrow batch at a time; no shuffle and no product of
    vocabulary and document. Empty names are padding and match nothing.
    """
    places = _vocabulary_places(names)
    values = np.array([float(w) for w in weights])
    cap = len(names)

    @F.arrow_udf(T.ArrayType(T.DoubleType(), True))
    def weigh(batch: pa.Array) -> pa.Array:
        matrix = np.zeros((len(batch), cap))
        for start, row, slot in places(batch):
            matrix[start + row, slot] = values[slot]
        offsets = pa.array(np.arange(0, (len(batch) + 1) * cap, max(cap, 1), dtype=np.int32)[: len(batch) + 1])
        return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel()))

    return weigh(tokens) if cap else F.array().cast("array<double>")


def _vocabulary_places(names: Sequence[str]) -> Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """A function from token lists to (first row, row from there, slot) of the tokens that ``names`` has, part by part."""
    slots = np.array([i for i, n in enumerate(names) if n], dtype=np.int64)
    known = [n for n in names if n]

    def places(batch: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        value_set = pa.array(known, type=pa.string())
        for start, end in list_parts(batch):
            part = batch.slice(start, end - start)
            found = pc.index_in(part.flatten(), value_set=value_set)
            hit = found.is_valid().to_numpy(zero_copy_only=False)
            yield start, _row_numbers(part)[hit], slots[found.drop_null().to_numpy(zero_copy_only=False)]

    return places


SPARSE_TYPE = T.StructType([T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))])


def vocabulary_pairs(tokens: Column | str, names: Sequence[str], weights: Sequence[float]) -> Column:
    """The elements of :func:`vocabulary_weights` that the row has: a struct of rising indices and their values."""
    places = _vocabulary_places(names)
    values = np.array([float(w) for w in weights])
    cap = max(len(names), 1)

    @F.arrow_udf(SPARSE_TYPE)
    def weigh(batch: pa.Array) -> pa.Array:
        parts = [np.unique((start + row) * cap + slot) for start, row, slot in places(batch)]
        pairs = np.concatenate(parts) if parts else np.zeros(0, np.int64)  # rows rise from part to part
        offsets = pa.array(np.searchsorted(pairs // cap, np.arange(len(batch) + 1)).astype(np.int32))
        slot = pairs % cap
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (slot.astype(np.int32), values[slot])]
        return pa.StructArray.from_arrays(lists, names=["indices", "values"])

    return weigh(tokens)


def sparse_dot(a: Column | str, b: Column | str) -> Column:
    """Dot product of two sparse structs: indices of both sides are merged, for a whole Arrow batch at a time."""

    def flat(side: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        indices, values = side.field("indices"), side.field("values")
        key = _row_numbers(indices) << 32 | indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return key, values.flatten().to_numpy(zero_copy_only=False)

    @F.arrow_udf(T.DoubleType())
    def dot(x: pa.Array, y: pa.Array) -> pa.Array:
        (i, v), (j, w) = flat(x), flat(y)
        both, at, to = np.intersect1d(i, j, assume_unique=True, return_indices=True)
        return pa.array(np.bincount(both >> 32, v[at] * w[to], minlength=len(x)))

    return dot(a, b)


def _little_endian(kind: str) -> np.dtype:
    return np.dtype({"int": "<i4", "float": "<f4", "double": "<f8"}[kind])


def pack_vector(vector: Column | str, kind: str = "float") -> Column:
    """A vector as bytes (little-endian numbers). One binary value per row is read several times
    faster than an array, whose elements are decoded one by one."""
    dtype = _little_endian(kind)

    @F.arrow_udf(T.BinaryType())
    def pack(batch: pa.Array) -> pa.Array:
        values = np.ascontiguousarray(batch.flatten().to_numpy(zero_copy_only=False), dtype=dtype)
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64) * dtype.itemsize
        flat = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(values)]
        )
        packed = flat.cast(pa.binary())
        return pc.if_else(batch.is_valid(), packed, pa.scalar(None, pa.binary())) if batch.null_count else packed

    return pack(vector)


def unpack_vector(packed: Column | str, kind: str = "float") -> Column:
    """The array behind :func:`pack_vector`."""
    dtype = _little_endian(kind)
    element = T.FloatType() if kind == "float" else T.DoubleType()

    @F.arrow_udf(T.ArrayType(element, True))
    def unpack(batch: pa.Array) -> pa.Array:
        sizes = pc.binary_length(batch).fill_null(0).to_numpy(zero_copy_only=False) // dtype.itemsize
        values = np.frombuffer(b"".join(batch.drop_null().to_pylist()), dtype=dtype)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        return pc.if_else(batch.is_valid(), lists, pa.scalar(None, lists.type)) if batch.null_count else lists

    return unpack(packed)


def model_embedding(
    text: Column | str, load: Callable[[], Callable[[Sequence[str]], Any]], batch: int = 256
) -> Column:
    """Embedding by a model. ``load`` runs once per worker task and returns a function that turns
    a list of texts into an (n, dim) array."""

    @F.arrow_udf(VECTOR_TYPE)
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = load()
        for texts in batches:
            values = texts.to_pylist()
            parts = [
                np.asarray(encode(values[i : i + batch]), dtype=np.float32)
                for i in range(0, len(values), batch)
            ]
            yield _as_float_lists(np.concatenate(parts)) if parts else pa.array(
                [], type=pa.list_(pa.float32())
            )

    # not deterministic for the optimizer: a filter on the vector must not run the model twice
    return embed.asNondeterministic()(text)


def embed_text(
    df: DataFrame,
    text: str = "text",
    out: str = "text_dense",
    dim: int = DENSE_SIZE,
    embedder: Callable[[], Callable[[Sequence[str]], Any]] | None = None,
    tokens: str | None = None,
) -> DataFrame:
    """Add a dense vector per text: the hashing embedder, or a model loaded by ``embedder()``.

    ``tokens`` names a column with the text's tokens, if there is one; the hashing embedder then does not split again.
    """
    if embedder is None:
        return df.withColumn(out, hash_embedding(F.col(tokens) if tokens else tokenize(text), dim))
    return df.withColumn(out, model_embedding(F.col(text), embedder))
