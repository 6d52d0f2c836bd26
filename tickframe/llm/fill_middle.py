"""Fill-in-the-middle documents from a seekable store of compressed frames.

``store`` writes every text as independent zstandard frames with cumulative unit counts (``frame_store``).
``transform`` reads such a store: the keys of a document choose two cuts in units; the cut frames alone are
decompressed to find them, all other frames go into the output as they are, in the output's order and between
small frames with the markers.  The output is again a seekable text.  ``digests`` streams its frames in order,
finds the markers, and streams the parts in the order of the text to rebuild it.

Everything is a map over rows: no shuffle, and a task holds one document's compressed frames and one open frame.

Defined cases: a NULL text counts as empty; a NULL id hashes as empty decimal text; empty texts and texts that
hold a marker stay plain; rows that repeat are transformed each; an empty table gives an empty table.  A text of
any length is cut as a whole.  Columns of ``docs`` besides the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.common import by_bytes, releasing, stage_table
from tickframe.llm.frame_store import FRAME_BYTES, Packer, Reader, cut_points, seek, unit_starts

#: The markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK = 4 << 20

STORED = "doc_id long, frames array<binary>, units array<long>, chars array<long>, sizes array<long>, marked boolean"
TRANSFORMED = ("doc_id long, n long, form string, prefix_units long, middle_units long, prefix_chars long, middle_chars long, "
               "output array<binary>")
DIGESTED = "output_sha256 string, restored_sha256 string"


@dataclass(frozen=True)
class Rates:
    """Of 100 documents, from ``fim`` on stay plain; of the others ``spm`` have their suffix first."""
    fim: int = 90
    spm: int = 20
    seed: str = "1"


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, frames, units, chars, sizes, marked) of every row; ``marked``: the text holds a marker."""
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return ids.mapInArrow(releasing(lambda batches: _store(batches, frame_bytes)), STORED)


def _store(batches: Iterable[pa.RecordBatch], frame_bytes: int) -> Iterator[pa.RecordBatch]:
    pack = Packer()
    for block in by_bytes(batches, "text", BLOCK):
        texts = block.column("text").combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        raw = memoryview(raw)[offsets[0]:offsets[-1]] if raw is not None else memoryview(b"")
        data = np.frombuffer(raw, np.uint8)
        offsets = offsets - offsets[0]
        units = np.concatenate([[0], np.cumsum(unit_starts(data, offsets[:-1]))])
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        stored: dict[str, list] = {name: [] for name in ("frames", "units", "chars", "sizes", "marked")}
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            text = raw[a:b]
            ends = cut_points(text, frame_bytes)
            stored["frames"].append([pack(text[s:e]) for s, e in zip([0, *ends], ends)])
            places = np.array(ends, np.int64) + a
            stored["units"].append((units[places] - units[a]).tolist())
            stored["chars"].append((chars[places] - chars[a]).tolist())
            stored["sizes"].append(ends)
            whole = bytes(text)
            stored["marked"].append(PREFIX in whole or SUFFIX in whole or MIDDLE in whole)
        yield pa.RecordBatch.from_arrays(
            [block.column("doc_id").combine_chunks(), pa.array(stored["frames"], pa.list_(pa.binary())),
             *(pa.array(stored[c], pa.list_(pa.int64())) for c in ("units", "chars", "sizes")),
             pa.array(stored["marked"], pa.bool_())],
            ["doc_id", "frames", "units", "chars", "sizes", "marked"])


def transform(stored: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, prefix_chars, middle_chars, output) of every stored row.

    ``output`` is the list of zstandard frames of the transformed text; joined they are a file."""
    return stored.mapInArrow(releasing(lambda batches: _map(batches, rates, False)), TRANSFORMED)


def transform_with_digests(stored: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """``transform`` with the SHA-256 of the output and of the text rebuilt from the output and its form."""
    return stored.mapInArrow(releasing(lambda batches: _map(batches, rates, True)), f"{TRANSFORMED}, {DIGESTED}")


def keys(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4))


def form_of(n: int, marked: bool, h3: int, h4: int, rates: Rates) -> str:
    if n == 0 or marked or h3 % 100 >= rates.fim:
        return "plain"
    return "spm" if h4 % 100 < rates.spm else "psm"


def _map(batches: Iterable[pa.RecordBatch], rates: Rates, digest: bool) -> Iterator[pa.RecordBatch]:
    pack, reader = Packer(), Reader()
    marks = {m: pack(m) for m in (PREFIX, SUFFIX, MIDDLE)}
    names = ["doc_id", "n", "form", "prefix_units", "middle_units", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
    if digest:
        names, types = [*names, "output_sha256", "restored_sha256"], [*types, pa.string(), pa.string()]
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            out: list[list] = [[] for _ in names]
            for row in batch.slice(start, 512).to_pylist():
                for column, value in zip(out, _one(row, rates, pack, reader, marks, digest)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def _one(row: dict, rates: Rates, pack: Packer, reader: Reader, marks: dict, digest: bool) -> tuple:
    frames, units, chars, sizes = row["frames"], row["units"], row["chars"], row["sizes"]
    n = units[-1] if units else 0
    h1, h2, h3, h4 = keys(row["doc_id"], rates.seed)
    form = form_of(n, row["marked"], h3, h4, rates)
    if form == "plain":
        found = (row["doc_id"], n, form, None, None, None, None, frames)
    else:
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        first, last = (seek(reader, frames, units, chars, sizes, u) for u in (a, b))
        prefix = _between(frames, (0, 0), first[:2], pack, reader)
        middle = _between(frames, first[:2], last[:2], pack, reader)
        suffix = _between(frames, last[:2], (len(frames), 0), pack, reader)
        p, s, m = [marks[PREFIX], *prefix], [marks[SUFFIX], *suffix], [marks[MIDDLE], *middle]
        found = (row["doc_id"], n, form, a, b - a, first[2], last[2] - first[2], p + s + m if form == "psm" else s + p + m)
    return (*found, *digests(found[-1], form, reader)) if digest else found


def _between(frames: list[bytes], start: tuple[int, int], stop: tuple[int, int], pack: Packer, reader: Reader) -> list[bytes]:
    """Frames of the text between two places (frame, byte): whole frames as they are, cut ones compressed anew."""
    (k, at), (last, end) = start, stop
    out = []
    while (k, at) < (last, end):
        if at == 0 and k < last:
            out.append(frames[k])
        else:
            data = reader.frame(frames[k])
            part = data[at:end if k == last else None]
            if part:
                out.append(pack(part))
        k, at = k + 1, 0
    return out


def digests(output: list[bytes], form: str, reader: Reader | None = None) -> tuple[str, str]:
    """SHA-256 of an output and of the text that its markers and form give back, streamed a frame at a time."""
    reader = reader or Reader()
    whole = hashlib.sha256()
    if form == "plain":
        for piece in reader.stream(output):
            whole.update(piece)
        return whole.hexdigest(), whole.hexdigest()
    marks = [PREFIX, SUFFIX, MIDDLE] if form == "psm" else [SUFFIX, PREFIX, MIDDLE]
    found: list[int] = []  # where the markers begin, in their order
    at, tail = 0, b""
    for piece in reader.stream(output):
        whole.update(piece)
        seen, base = tail + bytes(piece), at - len(tail)
        from_ = max(0, found[-1] + 3 - base) if found else 0
        while len(found) < 3 and (k := seen.find(marks[len(found)], from_)) >= 0:
            found.append(base + k)
            from_ = k + 3
        at += len(piece)
        tail = seen[-2:]
    if len(found) < 3 or found[0]:
        raise ValueError(f"not an output of form {form}")
    spans = {m: (start + 3, stop) for m, start, stop in zip(marks, found, [*found[1:], at])}
    rebuilt = hashlib.sha256()
    for mark in (PREFIX, MIDDLE, SUFFIX):
        for piece in reader.stream(output, *spans[mark]):
            rebuilt.update(piece)
    return whole.hexdigest(), rebuilt.hexdigest()


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rates: Rates = Rates(),
                   frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``transform_with_digests`` over a store of ``docs`` that is written to the shared checkpoint folder."""
    return transform_with_digests(stage_table(store(docs, id_col, text_col, frame_bytes), "frames"), rates)
