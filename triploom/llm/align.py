"""Alignment of the tokens that two tokenizers make of the same texts.

All tokens of both are intervals of bytes, sorted by start; a running maximum of their ends
says where a group is closed: a token that starts there starts the next one. In a group,
every token of one side is linked to those of the other side that it overlaps. How many
documents link a pair of ids is counted over the corpus, from one entry per block of
documents and pair, and told to the blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triploom.llm.coded_blocks import Numbering, packed, put_back, unpacked
from triploom.llm.pretokens import Chunk, chunked, gathered, pieces, spans
from triploom.llm.storage import stored

BLOCK_BYTES = 16 << 20
#: Tokens, groups and links of a chunk take some 250 times its bytes.
CHUNK_BYTES = 1 << 20
MERGED_PARTS = 8
DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BLOCKS = f"block long, part int, rows array<struct<{re.sub(r'(\w+) (\w+)', r'\1:\2', DOC)}>>, counts array<int>, codes binary, times binary, pairs array<long>, docs array<int>"
DOC_FIELDS = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("part", pa.int32()), ("rows", pa.list_(pa.struct(DOC_FIELDS))), ("counts", pa.list_(pa.int32())),
        ("codes", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
    ]
)


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """One tokenizer: the ids of words that it never joins, and the bytes of each id."""

    def __init__(self, table: list[bytes], encode: Callable[[list[bytes]], list[list[int]]]) -> None:
        self.size = len(table)
        self.encode = encode
        self.lengths = np.array([len(t) for t in table])
        self._starts, self._bytes = np.cumsum(self.lengths) - self.lengths, np.frombuffer(b"".join(table), np.uint8)
        digits = [b"%d," % i for i in range(len(table))]
        self.digit_sizes = np.array([len(d) for d in digits])
        self.digit_starts = np.cumsum(self.digit_sizes) - self.digit_sizes
        self.digits = np.frombuffer(b"".join(digits), np.uint8)

    def tokens(self, found: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, where each text's begin (and the end), and which texts can't be had back.

        Each distinct word is encoded once.
        """
        coded = found.dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        own = self.encode(words)
        sizes = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter(chain.from_iterable(own), np.int64, int(sizes.sum()))
        ids, ends = gathered(codes, np.cumsum(sizes) - sizes, sizes, flat)
        bad = np.r_[0, np.cumsum(self._lost(words, flat, sizes)[codes])][at]
        return ids, np.r_[0, ends][at], np.diff(bad) > 0

    def _lost(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which words differ from the bytes of their ids."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        made = np.diff(np.r_[0, np.cumsum(self.lengths[ids])][np.cumsum(np.r_[0, sizes])])
        joined, whole = gathered(ids, self._starts, self.lengths, self._bytes)[0].tobytes(), b"".join(words)
        if joined == whole and (made == lengths).all():
            return np.zeros(len(words), bool)
        lost, at = made != lengths, np.cumsum(np.r_[0, made]).tolist()
        return lost | np.array([joined[x:y] != w for x, y, w in zip(at[:-1], at[1:], words, strict=True)], bool)


@lru_cache(maxsize=2)
def byte_level(path: str) -> Side:
    """A byte-level tokenizer of the tokenizers library; special tokens in a text are text."""
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    signs = byte_of_sign()
    table = [b""] * (max(library.get_vocab().values()) + 1)
    for token, i in library.get_vocab().items():
        table[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()

    def encode(words: list[bytes]) -> list[list[int]]:
        return [e.ids for e in library.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    return Side(table, encode)


@lru_cache(maxsize=2)
def piecewise(path: str) -> Side:
    """A sentencepiece model that adds a space before a text, and no piece of which has a space inside.

    So it joins nothing across the place before a run of spaces, and words that begin with
    theirs can be encoded apart, the first space being the one that it adds.
    """
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    if any("▁" in name.lstrip("▁") for name in names):
        raise ValueError("pieces of this model reach across spaces")
    table = [bytes([int(n[3:5], 16)]) if library.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    space = library.piece_to_id("▁")

    def encode(words: list[bytes]) -> list[list[int]]:
        found = library.encode([w[1:].decode() for w in words], num_threads=1)
        return [ids if len(w) > 1 else [space] for w, ids in zip(words, found, strict=True)]

    return Side(table, encode)


def spaced_words(chunk: Chunk) -> tuple[pa.Array, np.ndarray]:
    """Runs of spaces with what follows them, and the number of the first one of each text (and the end)."""
    if not chunk.data:
        return pa.array([], pa.binary()), np.zeros(len(chunk.bounds), np.int64)
    space = np.frombuffer(chunk.data, np.uint8) == ord(" ")
    begins = np.r_[True, space[1:] & ~space[:-1]]
    begins[chunk.bounds[:-1][np.diff(chunk.bounds) > 0]] = True
    starts = np.flatnonzero(begins)
    return spans(chunk.data, starts), np.searchsorted(starts, chunk.bounds)


def kept(ids: np.ndarray, at: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the chosen texts alone, the others left without any."""
    sizes = np.diff(at)
    return ids[np.repeat(texts, sizes)], np.cumsum(np.r_[0, sizes * texts])


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of either side, whose tokens cover the same bytes without a gap."""
    a_starts, b_starts = np.r_[0, a_ends][:-1], np.r_[0, b_ends][:-1]
    starts, ends = np.r_[a_starts, b_starts], np.r_[a_ends, b_ends]
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order])
    closed = np.r_[False, starts[order][1:] >= reach[:-1]] if len(order) else np.zeros(0, bool)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(closed)
    return group[: len(a_ends)], group[len(a_ends) :]


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that share a byte: places of the one side and of the other."""
    a_starts, b_starts = np.r_[0, a_ends][:-1], np.r_[0, b_ends][:-1]
    low = np.searchsorted(b_ends, a_starts, "right")
    n = np.searchsorted(b_starts, a_ends, "left") - low
    one = np.repeat(np.arange(len(a_ends)), n)
    before = np.cumsum(n) - n
    return one, np.arange(len(one)) - before[one] + low[one]


def groups_text(a: Side, b: Side, a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;...`` of all groups, and where each group's text ends, its semicolon included."""
    a_at = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group, "left")
    b_at = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, "right")
    n = len(a_ids) + len(b_ids)
    starts, sizes = np.empty(n, np.int64), np.empty(n, np.int64)
    starts[a_at], sizes[a_at] = a.digit_starts[a_ids], a.digit_sizes[a_ids]
    starts[b_at], sizes[b_at] = b.digit_starts[b_ids] + len(a.digits), b.digit_sizes[b_ids]
    text, ends = gathered(np.arange(n), starts, sizes, np.r_[a.digits, b.digits])
    a_last, b_last = np.flatnonzero(np.diff(a_group, append=-1)), np.flatnonzero(np.diff(b_group, append=-1))
    text[ends[a_at[a_last]] - 1] = ord("|")
    text[ends[b_at[b_last]] - 1] = ord(";")
    return text, ends[b_at[b_last]]


class _Texts:
    """Counts, pairs and digest of one text, part by part."""

    def __init__(self) -> None:
        self.n = np.zeros(4, np.int64)
        self.digest, self.pairs, self.bad = hashlib.sha256(), [], False

    def add(self, n: np.ndarray, text: memoryview, pairs: tuple[np.ndarray, np.ndarray], bad: bool) -> None:
        if self.n.any() and n.any():
            self.digest.update(b";")
        self.n += n
        self.digest.update(text)
        self.pairs.append(pairs)
        if len(self.pairs) > MERGED_PARTS:
            self.pairs = [self._merged()]
        self.bad |= bad

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        pairs, place = np.unique(np.concatenate([p for p, _ in self.pairs]), return_inverse=True)
        return pairs, np.bincount(place, weights=np.concatenate([t for _, t in self.pairs])).astype(np.int64)

    def row(self) -> tuple[list, np.ndarray, np.ndarray]:
        if self.bad or not self.n.any():
            return [0, 0, 0, 0, ""], np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, times = self.pairs[0] if len(self.pairs) == 1 else self._merged()
        return [*self.n.tolist(), self.digest.hexdigest()], pairs, times


def _parts(a: Side, b: Side, chunk: Chunk) -> Iterator[tuple]:
    """What ``_Texts.add`` takes, for each text of the chunk."""
    a_ids, a_at, a_bad = a.tokens(*pieces(chunk))
    b_ids, b_at, b_bad = b.tokens(*spaced_words(chunk))
    bad = a_bad | b_bad
    if bad.any():
        (a_ids, a_at), (b_ids, b_at) = kept(a_ids, a_at, ~bad), kept(b_ids, b_at, ~bad)
    a_ends, b_ends = np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])
    a_group, b_group = groups_of(a_ends, b_ends)
    text, text_ends = groups_text(a, b, a_ids, b_ids, a_group, b_group)
    group_at = np.r_[a_group, a_group[-1:] + 1, 0][a_at]  # of the first token of each text, whose groups are its own
    text_at = np.r_[0, text_ends][group_at]
    one, other = links_of(a_ends, b_ends)
    text_of = np.repeat(np.arange(len(bad)), np.diff(a_at))
    span = a.size * b.size
    keys, times = np.unique(text_of[one] * span + a_ids[one] * b.size + b_ids[other], return_counts=True)
    pair_at = np.searchsorted(keys, np.arange(len(bad) + 1) * span)
    link_at = np.searchsorted(one, a_at)
    counts = np.stack([np.diff(x) for x in (a_at, b_at, group_at, link_at)], axis=1)
    view = memoryview(text)
    for i in range(len(bad)):
        own = slice(pair_at[i], pair_at[i + 1])
        yield counts[i], view[text_at[i] : max(text_at[i], text_at[i + 1] - 1)], (keys[own] % span, times[own]), bool(bad[i])


def _aligner(a_path: str, b_path: str, block_bytes: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, number = byte_level(a_path), piecewise(b_path), Numbering()
        rows, size, begun = [], 0, _Texts()

        def flushed() -> pa.RecordBatch:
            pairs, codes, docs = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True, return_counts=True)
            row = {"block": number(), "part": 0, "rows": [dict(zip([n for n, _ in DOC_FIELDS], r[0], strict=True)) for r in rows]}
            row |= {"counts": [len(r[1]) for r in rows], "codes": packed(codes), "times": packed(np.concatenate([r[2] for r in rows]))}
            return pa.RecordBatch.from_pylist([row | {"pairs": pairs, "docs": docs}], schema=SCHEMA)

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            spaced = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
            spaced = pc.if_else(pc.greater(pc.binary_length(texts), 0), spaced, pa.scalar("", texts.type))
            for chunk in chunked(spaced, chunk_bytes):
                size += len(chunk.data)
                for place, found in zip(chunk.rows, _parts(a, b, chunk), strict=True):
                    begun.add(*found)
                    if chunk.last:
                        own, pairs, times = begun.row()
                        rows.append(([ids[place], *own], pairs, times))
                        begun = _Texts()
                if size >= block_bytes and chunk.last:
                    yield flushed()
                    rows, size = [], 0
        if rows:
            yield flushed()

    return run


def _new_fill():
    def fill(block: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        codes, times = unpacked(block["codes"][0].as_py()), unpacked(block["times"][0].as_py()).astype(np.int64)
        n, best = answers["n"].to_numpy(), answers["best"].to_numpy().astype(np.int64)
        at = np.cumsum(np.r_[0, block["counts"].chunk(0).flatten().to_numpy()])
        rows = pa.RecordBatch.from_struct_array(block["rows"].chunk(0).flatten())
        sums = [np.diff(np.r_[0, np.cumsum(x[codes] * times)][at]) for x in (best, n)]
        yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(s, pa.int64()) for s in sums)], names=[*rows.schema.names, "n_best", "count_sum"])

    return fill


def blocks_of(docs: DataFrame, a_path: str, b_path: str, block_bytes: int = BLOCK_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Documents in blocks with the distinct pairs of each and the number of its documents that link them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_aligner(a_path, b_path, block_bytes, chunk_bytes), BLOCKS), "aligned")


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """How many documents link each pair, and whether no pair of its first id is in more; the pair is ``a * n_b + b``."""
    entries = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("e")).select("e.pairs", "e.docs")
    counts = stored(entries.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n")), "pair-counts")
    first = F.floor(F.col("pair") / n_b).alias("first")
    most = counts.groupBy(first).agg(F.max("n").alias("most"))  # a row per id of the vocabulary at most
    return counts.withColumn("first", F.floor(F.col("pair") / n_b)).join(F.broadcast(most), "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, **sizes: int) -> DataFrame:
    """Groups and links of the tokens of A (byte level) and B (pieces) in every row of ``docs``.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count tokens, groups and links,
    ``groups_sha256`` is the digest of the ids by group, ``count_sum`` adds over the links how
    many rows of ``docs`` hold their pair of ids linked, ``n_best`` counts the links whose
    pair is the most frequent of its A id. Texts that are NULL, empty or not to be had back
    from the tokens of either side (with a space before them) have zeros and an empty digest,
    and link nothing. Repeated rows and doc_ids count as often as they occur; other columns
    aren't carried along.
    """
    blocks = blocks_of(docs, a_path, b_path, **sizes)
    counts = pair_counts(blocks, piecewise(b_path).size)
    entries = blocks.select("block", "part", F.posexplode("pairs").alias("code", "pair"))
    answers = entries.join(counts, "pair").select("block", "part", "code", "n", "best")
    return put_back(blocks.select("block", "part", "rows", "counts", "codes", "times"), answers, _new_fill, f"{DOC}, n_best long, count_sum long")
