"""Helpers of the operators: tables, staged results and hashing of whole Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.session import scratch_path

#: Bytes of text that one block of a task holds; a longer text is a block of its own.
BLOCK = 1 << 19
#: Rows that cross to Python at once while a table is written; the session's own setting may be less.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
FILES_PER_SLOT = 4
MULTIPLIER = 0x9E3779B97F4A7C15
U = np.uint64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(df: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage and survives lost executors.

    A ``narrow`` table of a few numbers a row, written often, goes to a few files for each slot of the cluster.
    """
    path = scratch_path(df.sparkSession, label)
    if narrow:
        df = df.coalesce(FILES_PER_SLOT * df.sparkSession.sparkContext.defaultParallelism)
    conf = df.sparkSession.conf
    before = conf.get(BATCH_SETTING)
    conf.set(BATCH_SETTING, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        conf.set(BATCH_SETTING, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Ids and texts only (null text: empty), whatever other columns there are."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a text or binary column as one byte array, and its len + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Split a batch into runs of rows with a bounded size of text: first row, end row, bytes, offsets."""
    data, at = flat_bytes(batch.column(text))
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, U)
    filled, step = 1, base
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * U(step & (2**64 - 1))
        filled, step = filled + more, step * step % 2**64
    return out


class Tables:
    """Byte codes, powers and inverse powers for sequences of one size. Tasks make their own: nothing travels."""

    def __init__(self):
        self.codes = np.random.default_rng(20).integers(0, 2**64, 256, dtype=U) | U(1)
        self.up = self.down = np.ones(1, U)

    def __reduce__(self):
        return Tables, ()

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers for n places at least; sizes are rounded up, so few are ever made."""
        if len(self.up) < n:
            size = max(1 << 16, 1 << int(n - 1).bit_length())
            self.up, self.down = powers(MULTIPLIER, size), powers(pow(MULTIPLIER, -1, 2**64), size)
        return self.up, self.down


TABLES = Tables()


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(29)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(32)
    return x


class Rolling:
    """Hashes of any ranges of a sequence of codes in constant time each (sums of powers modulo 2^64)."""

    def __init__(self, codes: np.ndarray):
        up, self.down = TABLES.get(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, U)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, U)
        return mix((self.sums[width:] - self.sums[:-width]) * self.down[:n])


def byte_codes(data: np.ndarray) -> np.ndarray:
    return TABLES.codes[data]


def word_spans(data: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block: starts, ends and each text's first word (one more entry than texts).

    ``inside`` tells by byte value what belongs to words; words end where texts end.
    """
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = inside[data]
    step = np.diff(word)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = np.unique(ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(data))])
    cuts = cuts[(word[cuts] == 1) & (word[cuts + 1] == 1)]  # a text ends inside of a word
    if len(cuts):
        start, end = np.sort(np.r_[start, cuts]), np.sort(np.r_[end, cuts])
    first = np.searchsorted(start, np.r_[0, ends[:-1]] if len(ends) else np.zeros(0, np.int64))
    return start, end, np.r_[first, len(start)].astype(np.int64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values, from block-wise running minima."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def winnow(hashes: np.ndarray, width: int, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that choose the same hash: its place, the first and the last window of each run.

    Window p covers hashes[p : p + width]; the leftmost smallest one is chosen, so windows with equal
    content choose at equal distance from their start. ``valid`` marks the windows that count.
    """
    if len(hashes) < width:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    low = U((1 << 31) - 1)  # places; the high bits of the hashes give the order, alike in every block
    chosen = sliding_min((hashes & ~low) | np.arange(len(hashes), dtype=U), width)
    place = (chosen & low).astype(np.int64)
    ok = valid[: len(place)]
    change = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (ok[1:] != ok[:-1])])
    last = np.r_[change[1:], len(place)] - 1
    good = ok[change]
    return place[change][good], change[good], last[good]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each range, one after another."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(total)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def batches_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def per_task(make: Callable[[], Callable]) -> Callable:
    """A function that builds its worker once per task, for mapInArrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return run
