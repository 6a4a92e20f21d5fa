"""Fill-in-the-middle forms over a store of seekable compressed frames.

1. :func:`frame_store` cuts each text into frames of bounded size, at ends of units where there are any, and
   compresses every frame on its own (zstandard). With each frame goes how many units, code points and bytes end by it.
2. A cut after k units lies in the first frame by which k units end. Only that frame is decompressed to find the place
   (:meth:`Frames.cut`). All other frames move into the output as they are, compressed (:func:`fill_in_middle`).
3. Digests stream the ordered frames of the output; the text is rebuilt from the output and its form alone, by
   finding the marks and reading what stands between them in the text's order (:func:`restored`).

A unit is white space and the word after it, or white space at the end. Where a document is cut, and its form, come
from a digest of seed and id, so all rows of one id are cut by the same numbers. A null id counts as an empty one; null
texts are empty, and empty texts and texts that hold a mark stay plain. Repeated rows give repeated rows. Only id and text
are read; an empty table gives no rows. A text, of any length, is held by one task: frame by frame where it is cut and
streamed, whole only where it is first read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from loomdex.llm.common import flat_bytes, per_task, texts_of
from loomdex.llm.words import SOLID

#: Bytes of text in a frame, at most.
FRAME = 1 << 16
SEED = 42
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Percent of texts that get a form, and of these the percent with the suffix first.
SHARE, SUFFIX_FIRST = 50, 80
FRAME_TYPE = "array<struct<units:bigint,chars:bigint,bytes:bigint,data:binary>>"
STORE = f"doc_id long, units long, marked boolean, frames {FRAME_TYPE}"
FORMS = f"doc_id long, units long, form string, prefix_chars long, middle_chars long, frames {FRAME_TYPE}"
_FRAMES = pa.list_(pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("data", pa.binary())]))


def unit_ends(data: np.ndarray) -> np.ndarray:
    """Bytes by which the units of a text end."""
    if not len(data):
        return np.zeros(0, np.int64)
    solid = SOLID[data]
    return np.append(np.flatnonzero(solid[:-1] & ~solid[1:]) + 1, len(data))


def code_points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


class Frames:
    """Ordered frames (units, chars, bytes that end by each; compressed data) of one text."""

    def __init__(self, units: list[int], chars: list[int], ends: list[int], data: list[bytes]):
        self.units, self.chars, self.ends, self.data = units, chars, ends, data
        self._open = zstandard.ZstdDecompressor()
        self._last: tuple[int, bytes] = (-1, b"")

    def size(self) -> int:
        return self.ends[-1] if self.ends else 0

    def read(self, k: int) -> bytes:
        if self._last[0] != k:
            self._last = (k, self._open.decompress(self.data[k]))
        return self._last[1]

    def span(self, low: int, high: int) -> Iterator[bytes]:
        """The bytes from ``low`` to ``high``, frame by frame."""
        k = bisect_left(self.ends, low + 1)
        while low < high:
            start = self.ends[k - 1] if k else 0
            yield self.read(k)[low - start : high - start]
            low, k = self.ends[k], k + 1

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` units."""
        if not units:
            return 0, 0
        k = bisect_left(self.units, units)
        before = (self.units[k - 1], self.chars[k - 1], self.ends[k - 1]) if k else (0, 0, 0)
        data = np.frombuffer(self.read(k), np.uint8)
        solid = SOLID[data]
        inner = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
        nth = units - before[0]
        at = int(inner[nth - 1]) if nth <= len(inner) else len(data)
        return before[2] + at, before[1] + code_points(data[:at])

    def parts(self, low: int, high: int) -> Iterator[tuple[bytes, bool]]:
        """Frames between two places: whole ones compressed as they are (True), what is left of cut ones as bytes."""
        k = bisect_left(self.ends, low + 1)
        while low < high:
            start = self.ends[k - 1] if k else 0
            if low == start and self.ends[k] <= high:
                yield self.data[k], True
            else:
                yield self.read(k)[low - start : high - start], False
            low, k = self.ends[k], k + 1


def framed(data: np.ndarray, pack: zstandard.ZstdCompressor, size: int = FRAME) -> tuple[int, list[tuple]]:
    """Number of units of a text, and its frames."""
    ends = unit_ends(data)
    out, at, chars = [], 0, 0
    while at < len(data):
        limit = at + size
        if limit >= len(data):
            limit = len(data)
        else:
            k = int(np.searchsorted(ends, limit, "right"))
            if k and ends[k - 1] > at:
                limit = int(ends[k - 1])
            else:  # a unit longer than a frame is cut between code points
                limit -= next((i for i in range(4) if limit - i > at and data[limit - i] & 0xC0 != 0x80), 0)
        chars += code_points(data[at:limit])
        out.append((int(np.searchsorted(ends, limit, "right")), chars, limit, pack.compress(data[at:limit].tobytes())))
        at = limit
    return len(ends), out


def _frame_column(rows: list[list[tuple]]) -> pa.Array:
    flat = [f for row in rows for f in row]
    fields = [pa.array([f[i] for f in flat], _FRAMES.value_type.field(i).type) for i in range(4)]
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(_FRAMES.value_type)))


def _frames_of(column: pa.ListArray) -> Iterator[Frames]:
    for frames in column:
        items = frames.as_py() or []
        yield Frames(*([f[n] for f in items] for n in ("units", "chars", "bytes", "data")))


def frame_store(docs: DataFrame, size: int = FRAME) -> DataFrame:
    """One row per document: doc_id, number of units, whether its text holds a mark, and its frames."""

    def make():
        pack = zstandard.ZstdCompressor()

        def work(batch):
            data, at = flat_bytes(batch.column("text"))
            found, marked = [], []
            for low, high in zip(at[:-1], at[1:]):
                whole = data[low:high]
                found.append(framed(whole, pack, size))
                raw = whole.tobytes()
                marked.append(any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)))
            columns = [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array(marked), _frame_column([f for _, f in found])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "units", "marked", "frames"])

        return work

    return texts_of(docs).mapInArrow(per_task(make), STORE)


def choice(doc_id: int | None, units: int, plain: bool, seed: int = SEED) -> tuple[str, int, int]:
    """Form of a document, and after how many units its prefix and its middle end."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if plain or h3 % 100 >= SHARE:
        return "plain", 0, 0
    first, last = sorted((h1 % (units + 1), h2 % (units + 1)))
    return ("spm" if h4 % 100 < SUFFIX_FIRST else "psm"), first, last


def _assembled(frames: Frames, order: Iterable[tuple[bytes, int, int]], pack: zstandard.ZstdCompressor) -> list[tuple]:
    """Frames of an output: for each part a mark and the bytes of a range. Units are not counted in outputs."""
    out: list[tuple] = []
    at, held = 0, b""

    def add(data: bytes, size: int) -> None:
        nonlocal at
        at += size
        out.append((0, 0, at, data))

    for mark, low, high in order:
        held += mark
        for part, whole in frames.parts(low, high):
            if whole:
                if held:
                    add(pack.compress(held), len(held))
                    held = b""
                add(part, zstandard.frame_content_size(part))
            else:
                held += part
                if len(held) >= FRAME:
                    add(pack.compress(held), len(held))
                    held = b""
    if held:
        add(pack.compress(held), len(held))
    return out


def fill_in_middle(store: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document of a store: its form, the code points of prefix and middle (null: plain), the output's frames."""

    def make():
        pack = zstandard.ZstdCompressor()

        def work(batch):
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "units", "marked"))
            for doc_id, units, marked, frames in zip(*columns, _frames_of(batch.column("frames"))):
                form, first, last = choice(doc_id, units, marked or not frames.size(), seed)
                if form == "plain":
                    kept = list(zip(frames.units, frames.chars, frames.ends, frames.data))
                    rows.append((doc_id, units, form, None, None, kept))
                    continue
                (a, chars_a), (b, chars_b) = frames.cut(first), frames.cut(last)
                prefix, middle, suffix = (PREFIX, 0, a), (MIDDLE, a, b), (SUFFIX, b, frames.size())
                order = (prefix, suffix, middle) if form == "psm" else (suffix, prefix, middle)
                rows.append((doc_id, units, form, chars_a, chars_b - chars_a, _assembled(frames, order, pack)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            out = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            names = ["doc_id", "units", "form", "prefix_chars", "middle_chars", "frames"]
            yield pa.RecordBatch.from_arrays([*out, _frame_column([r[5] for r in rows])], names=names)

        return work

    return store.mapInArrow(per_task(make), FORMS)


def _marks(frames: Frames) -> dict[bytes, int]:
    """Where the marks stand in an output; no text with a mark of its own gets one."""
    found: dict[bytes, int] = {}
    tail, at = b"", 0
    for part in frames.span(0, frames.size()):
        joined = tail + part
        for mark in (PREFIX, SUFFIX, MIDDLE):
            if mark not in found and (place := joined.find(mark)) >= 0:
                found[mark] = at - len(tail) + place
        tail, at = joined[-2:], at + len(part)
    return found


def restored(frames: Frames, form: str) -> Iterator[bytes]:
    """The text's bytes from an output and its form."""
    if form == "plain":
        yield from frames.span(0, frames.size())
        return
    at, end = _marks(frames), frames.size()
    places = sorted(at.values())
    for mark in (PREFIX, MIDDLE, SUFFIX):
        after = [p for p in places if p > at[mark]]
        yield from frames.span(at[mark] + len(mark), after[0] if after else end)


def outputs(forms: DataFrame, text: bool = True, digests: bool = True) -> DataFrame:
    """Rows of :func:`fill_in_middle` with the output as ``text``, and digests of it and of the text rebuilt from it."""
    names = ["output"] * text + ["output_sha256", "restored_sha256"] * digests

    def make():
        def work(batch):
            rows = []
            for form, frames in zip(batch.column("form").to_pylist(), _frames_of(batch.column("frames"))):
                row = [b"".join(frames.span(0, frames.size()))] if text else []
                if digests:
                    for parts in (frames.span(0, frames.size()), restored(frames, form)):
                        digest = hashlib.sha256()
                        for part in parts:
                            digest.update(part)
                        row.append(digest.hexdigest())
                rows.append(row)
            kept = batch.select(["doc_id", "units", "form", "prefix_chars", "middle_chars"])
            kinds = [pa.binary()] * text + [pa.string()] * 2 * digests
            more = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
            if text:
                more[0] = more[0].view(pa.string())
            yield pa.RecordBatch.from_arrays([*kept.columns, *more], names=[*kept.schema.names, *names])

        return work

    schema = "doc_id long, units long, form string, prefix_chars long, middle_chars long"
    return forms.mapInArrow(per_task(make), schema + "".join(f", {n} string" for n in names))


def oracle(seed: int = SEED, table: str = "documents") -> str:
    """The same rows, digests included, in another engine's SQL."""
    space, solid = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    return f"""
    with base as (
      select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{space}*{solid}+|{space}+') as u,
             sha256('{seed}:' || coalesce(cast(doc_id as varchar), '')) as d
      from {table}),
    nums as (
      select doc_id, t, u, len(u) as n, ('0x' || d[1:8])::bigint as h1, ('0x' || d[9:16])::bigint as h2,
             ('0x' || d[17:24])::bigint as h3, ('0x' || d[25:32])::bigint as h4
      from base),
    cut as (
      select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= {SHARE} then 'plain'
                  when h4 % 100 < {SUFFIX_FIRST} then 'spm' else 'psm' end as form
      from nums),
    parts as (
      select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:n], '') as s from cut),
    made as (
      select *, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                else '<S>' || s || '<P>' || p || '<M>' || m end as o from parts)
    select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
           case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
           sha256(o) as output_sha256, sha256(case when form = 'plain' then o else p || m || s end) as restored_sha256
    from made"""
