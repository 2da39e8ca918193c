"""Fill-in-middle over texts kept as seekable compressed frames.

A text is cut into independent zstandard frames, each with the number of units that begin
before it and in it, so that a place given in units is found in the one frame that holds it.
Choosing the cuts decompresses only the frames of the cuts; the output is streamed from the
frames in its order, and so is the text rebuilt from the output.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.llm.storage import stored

FRAME_BYTES = 32 << 10
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The parts of the output in its order, each after its mark.
ORDERS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
FRAMES = "doc_id long, n long, marked boolean, frames array<binary>, ends array<long>, units array<long>, chars array<long>, opens array<boolean>"
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("frames", pa.list_(pa.binary())), ("ends", pa.list_(pa.int64())),
        ("units", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64())), ("opens", pa.list_(pa.bool_())),
    ]
)


def unit_starts(raw: np.ndarray, opens: bool) -> np.ndarray:
    """Where units begin: white space after none, and the first byte if ``opens``."""
    white = WHITE[raw]
    begins = np.r_[opens, white[1:] & ~white[:-1]] if len(raw) else np.zeros(0, bool)
    return np.flatnonzero(begins)


class Frames:
    """Bytes as independent frames of at most ``FRAME_BYTES``; ``ends`` counts the bytes."""

    def __init__(self, frames: list[bytes] | None = None, ends: list[int] | None = None) -> None:
        self.frames, self.ends = frames or [], ends or []
        self._codec, self._reader = zstandard.ZstdCompressor(3), zstandard.ZstdDecompressor()

    def append(self, content: bytes) -> None:
        self.frames.append(self._codec.compress(content))
        self.ends.append(self.length + len(content))

    @property
    def length(self) -> int:
        return self.ends[-1] if self.ends else 0

    def frame(self, i: int) -> bytes:
        return self._reader.decompress(self.frames[i])

    def read(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes from ``start`` to ``stop``, frame by frame; no other frame is touched."""
        if start >= stop:
            return
        for i in range(int(np.searchsorted(self.ends, start, "right")), len(self.frames)):
            begin = self.ends[i - 1] if i else 0
            if begin >= stop:
                return
            yield self.frame(i)[max(0, start - begin) : stop - begin]


def frames_of(text: bytes) -> dict:
    """The frames of one text, cut between characters, with what they hold cumulated."""
    raw, out = np.frombuffer(text, np.uint8), Frames()
    units, chars, opens = [], [], []
    at = n = m = 0
    while at < len(text):
        stop = min(at + FRAME_BYTES, len(text))
        while stop < len(text) and text[stop] & 0xC0 == 0x80:
            stop -= 1
        part = raw[at:stop]
        opens.append(bool(at == 0 or WHITE[raw[at]] and not WHITE[raw[at - 1]]))
        n += len(unit_starts(part, opens[-1]))
        m += int(np.count_nonzero((part & 0xC0) != 0x80))
        units.append(n)
        chars.append(m)
        out.append(text[at:stop])
        at = stop
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    return {"n": n, "marked": marked, "frames": out.frames, "ends": out.ends, "units": units, "chars": chars, "opens": opens}


def _framer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            docs, texts = (batch.column(c).slice(start, 64).to_pylist() for c in ("doc_id", "text"))
            rows = [{"doc_id": d} | frames_of(t or b"") for d, t in zip(docs, texts, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)


def framed(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as frames, written to the shared folder; a NULL text is empty.

    ``n`` is the number of units: white space with what follows up to the next white space,
    or white space at the end. ``marked`` says that the text holds one of the marks.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(rows.mapInArrow(_framer, FRAMES), "frames")


def draws(seed: int) -> list[Column]:
    """Four 32-bit numbers per doc_id, from the SHA-256 of ``seed:doc_id``; a NULL is an empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def planned(frames: DataFrame, seed: int = 42, plain: int = 50, spm: int = 80) -> DataFrame:
    """``frames`` with ``first`` and ``second``, the cuts in units, and ``form``.

    ``plain`` percent of the documents with units and without marks are transformed, ``spm``
    percent of these suffix first.
    """
    h1, h2, h3, h4 = draws(seed)
    one, two = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    form = F.when((F.col("n") == 0) | F.col("marked") | (h3 % 100 >= plain), "plain").when(h4 % 100 < spm, "spm").otherwise("psm")
    return frames.withColumns({"first": F.least(one, two), "second": F.greatest(one, two), "form": form})


def cut_at(text: Frames, units: list[int], chars: list[int], opens: list[bool], unit: int) -> tuple[int, int]:
    """The byte and the character before which ``unit`` units lie, from one frame."""
    if not units or unit >= units[-1]:
        return text.length, chars[-1] if chars else 0
    i = int(np.searchsorted(units, unit, "right"))
    begin, before, counted = (text.ends[i - 1], units[i - 1], chars[i - 1]) if i else (0, 0, 0)
    raw = np.frombuffer(text.frame(i), np.uint8)
    at = int(unit_starts(raw, opens[i])[unit - before])
    return begin + at, counted + int(np.count_nonzero((raw[:at] & 0xC0) != 0x80))


def output(text: Frames, form: str, first: int, second: int) -> Iterator[bytes]:
    """The output in its order, the cuts given in bytes."""
    if form == "plain":
        yield from text.read(0, text.length)
        return
    bounds = (0, first, second, text.length)
    for mark, part in ORDERS[form]:
        yield mark
        yield from text.read(bounds[part], bounds[part + 1])


def reframed(parts: Iterable[bytes]) -> Frames:
    out, held, size = Frames(), [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= FRAME_BYTES:
            out.append(b"".join(held))
            held, size = [], 0
    if size:
        out.append(b"".join(held))
    return out


def restored(made: Frames, form: str) -> Iterator[bytes]:
    """The text, from nothing but the output and its form."""
    if form == "plain":
        yield from made.read(0, made.length)
        return
    order, found, tail, at = ORDERS[form], [], b"", 0
    for i in range(len(made.frames)):
        window = tail + made.frame(i)
        base, place = at - len(tail), 0
        while len(found) < len(order) and (place := window.find(order[len(found)][0], place)) >= 0:
            found.append(base + place)
            place += len(PREFIX)
        at, tail = made.ends[i], window[-2:]
    if len(found) != len(order):
        raise ValueError("the output lacks a mark")
    spans = {part: (start + len(PREFIX), stop) for (_, part), start, stop in zip(order, found, [*found[1:], made.length], strict=True)}
    for part in range(3):
        yield from made.read(*spans[part])


def _digest(parts: Iterable[bytes]) -> str:
    found = hashlib.sha256()
    for part in parts:
        found.update(part)
    return found.hexdigest()


def _pieces(row: dict) -> tuple[Frames, int, int, int | None, int | None]:
    text = Frames(row["frames"], row["ends"])
    if row["form"] == "plain":
        return text, 0, 0, None, None
    places = (row["units"], row["chars"], row["opens"])
    first, prefix = cut_at(text, *places, row["first"])
    second, both = cut_at(text, *places, row["second"])
    return text, first, second, prefix, both - prefix


def _transformer(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part, out = batch.slice(start, 64), []
                for row in part.to_pylist():
                    text, first, second, prefix, middle = _pieces(row)
                    if keep:
                        made = b"".join(output(text, row["form"], first, second))
                        out.append({"output": made.decode()})
                    else:
                        digest = hashlib.sha256()

                        def passed(parts: Iterable[bytes], digest=digest) -> Iterator[bytes]:
                            for x in parts:
                                digest.update(x)
                                yield x

                        made = reframed(passed(output(text, row["form"], first, second)))
                        out.append({"output_sha256": digest.hexdigest(), "restored_sha256": _digest(restored(made, row["form"]))})
                    out[-1] |= {"doc_id": row["doc_id"], "n": row["n"], "form": row["form"], "prefix_chars": prefix, "middle_chars": middle}
                kinds = [(c, pa.int64()) for c in ("doc_id", "n", "prefix_chars", "middle_chars")] + [("form", pa.string())]
                names = ["output"] if keep else ["output_sha256", "restored_sha256"]
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*kinds, *((c, pa.string()) for c in names)]))

    return run


COLUMNS = "doc_id long, n long, prefix_chars long, middle_chars long, form string"


def outputs(docs: DataFrame, **options) -> DataFrame:
    """The transformed text of every row, ``output``, with ``form`` and the lengths of the parts in characters."""
    return planned(framed(docs), **options).mapInArrow(_transformer(True), f"{COLUMNS}, output string")


def digests(docs: DataFrame, **options) -> DataFrame:
    """As ``outputs``, but the SHA-256 of the output and of the text rebuilt from it, both streamed.

    Every row is kept, repeated and NULL doc_ids too; an empty or NULL text is plain, and so
    is one that holds a mark. No task holds a whole output: it lies in frames again while the
    text is rebuilt.
    """
    return planned(framed(docs), **options).mapInArrow(_transformer(False), f"{COLUMNS}, output_sha256 string, restored_sha256 string")
