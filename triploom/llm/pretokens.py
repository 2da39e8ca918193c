"""Texts cut into the pieces that a byte-level tokenizer encodes one by one, many texts at a time.

``PATTERN`` matches, from left to right, a contraction, a run of letters, of numbers or of
other signs (each with one space before it, if there is one), or white space. So pieces
begin where the class of the character changes, but for the last white space before
something else, which stands alone or leads the next piece, and for contractions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken

#: The only pattern that ``pieces`` knows.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
OTHER, LETTER, NUMBER, SPACE = range(4)
CHUNK_BYTES = 4 << 20
SAFE_CUT = re.compile(rb"[!-~] ")


class Chunk(NamedTuple):
    """UTF-8 of successive texts, or part ``part`` of one long text.

    ``bounds`` holds the offset of each text of ``rows`` and the end of the last one.
    """

    data: bytes
    bounds: np.ndarray
    rows: range
    part: int
    last: bool


def chunked(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts (NULL as empty) in chunks of about ``limit`` bytes.

    A longer text comes in parts, cut before a space that follows a printable ASCII sign:
    no piece of a tokenizer reaches across such a place.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(texts.buffers()[2] or b"")
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        own = bytes(data[offsets[start] : offsets[end]])
        if end > start + 1 or len(own) <= limit:
            yield Chunk(own, offsets[start : end + 1] - offsets[start], range(start, end), 0, True)
        else:
            at = part = 0
            while at < len(own) or not part:
                cut = SAFE_CUT.search(own, at + limit)
                stop = cut.start() + 1 if cut else len(own)
                yield Chunk(own[at:stop], np.array([0, stop - at]), range(start, end), part, stop == len(own))
                at, part = stop, part + 1
        start = end


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point as the regular expressions of tiktoken see it."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    single = {bytes([i]): i for i in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        found = bytes(tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        table[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = kind
    return table


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which code points begin a piece; ``first`` are the places where texts begin."""
    kind = classes()[points]
    begins = np.r_[True, kind[1:] != kind[:-1]]
    begins[first] = True
    closes = np.r_[begins[1:], True]
    ends = np.zeros(len(points), bool)
    ends[np.r_[first[1:] - 1, len(points) - 1]] = True
    alone = begins & closes

    space = np.flatnonzero(closes & (kind == SPACE) & ~ends)
    begins[space] = True
    leads = np.zeros(len(points), bool)
    leads[space[points[space] == ord(" ")]] = True
    begins[1:][leads[:-1]] = False

    marks = np.flatnonzero(alone & (points == ord("'")) & ~ends)
    marks = marks[~((marks > 0) & leads[marks - 1])]
    padded = np.r_[points, 0, 0]
    one, two = padded[marks + 1], padded[marks + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    long &= ~short & ~np.r_[ends, True][marks + 1]
    for found, size in ((marks[short], 2), (marks[long], 3)):
        begins[found + 1] = False
        after = found + size
        begins[after[after < len(points)]] = True
    return begins


def pieces(chunk: Chunk) -> tuple[pa.Array, np.ndarray]:
    """All pieces of the chunk as binary values, and the number of the first one of each text (and the end)."""
    if public_tokenizers.PATTERN != PATTERN:
        raise ValueError("the pattern of the vocabularies has changed")
    if not chunk.data:
        return pa.array([], pa.binary()), np.zeros(len(chunk.bounds), np.int64)
    leading = np.flatnonzero((np.frombuffer(chunk.data, np.uint8) & 0xC0) != 0x80)
    points = np.frombuffer(chunk.data.decode().encode("utf-32-le"), np.uint32)
    first = np.searchsorted(leading, np.unique(chunk.bounds[:-1]))
    starts = leading[np.flatnonzero(piece_starts(points, first[first < len(points)]))]
    return spans(chunk.data, starts), np.searchsorted(starts, chunk.bounds)


def spans(data: bytes, starts: np.ndarray) -> pa.Array:
    """``data`` cut at ``starts``, the first of which is 0, without a copy."""
    offsets = np.r_[starts, len(data)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def gathered(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all ``codes`` in order, code ``c`` standing for ``sizes[c]`` values from ``starts[c]`` on; and where each ends."""
    taken = sizes[codes]
    ends = np.cumsum(taken)
    at = np.repeat(starts[codes] - (ends - taken), taken)
    at += np.arange(len(at))
    return values[at], ends
