"""Token ids in files of canonical Huffman code with checkpoints.

File: the magic, the longest code length (1 byte), the number of symbols (u32), each symbol
with its code length (u32, u8), then documents. A document is: doc_id (i64, and a byte that
is 0 for NULL), its number of ids (u32), the bit offset of each block of ``BLOCK_IDS`` ids
after the first (u32), the number of code bytes (u32) and the code, padded to whole bytes.
All numbers are little-endian; code bits run from the highest bit of each byte. Blocks
decode independently of each other, by one look into a table per id.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triploom.llm.storage import open_folder, shared_folder, stored

MAGIC = b"TLHUF1\0\0"
LONGEST = 16
BLOCK_IDS = 256
CACHE_PIECES = 600_000
TEXT_AT_ONCE = 12 << 20
MARKS = ("\n", ".", ",")
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
TOGETHER = 2_000
IDS_AT_ONCE = 1 << 20
ROLL_BYTES = 64 << 20
RANGES_PER_TASK = 2


@lru_cache(maxsize=2)
def _encoder(path: str, cached: int) -> PieceEncoder:
    return PieceEncoder(path, cached)


class PieceEncoder:
    """Whole texts to ids with the library, which sees each distinct piece about once.

    A byte-level tokenizer never lets an id cross from a character that is no white space
    to a single space or line break before another such character, nor from a letter or
    digit to punctuation. So a text is cut at these places, the ids of its pieces are
    joined, and Arrow finds the distinct pieces of many texts. New ones go to the library
    as one text; the ids that start with the space or break begin the pieces. Texts with
    other white space or punctuation at a cut are encoded as they are.
    """

    def __init__(self, path: str, cached: int = CACHE_PIECES) -> None:
        self._cached = cached
        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        self.width = "<u2" if max(vocabulary.values(), default=0) < 1 << 16 else "<u4"
        self._spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token[0] in "ĠĊ"]] = True
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._known: dict[str, bytes | None] = {}
        self._older: dict[str, bytes | None] = {}
        self._tails: dict[str, bytes] = {}
        self._first: dict[str, bytes | None] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.width).tobytes() for e in found]

    def _cut_tail(self, piece: str) -> str:
        """The piece without closing punctuation, if a letter comes before that.

        Punctuation after a letter is a unit of its own to a byte-level tokenizer.
        """
        core = piece.rstrip(TAIL)
        cut = core != piece and core[-1:].isalpha() and not any(x in piece for x in self._special)
        return core if cut else piece

    def _learn(self, pieces: set[str]) -> None:
        """Find the ids of new pieces; those of the generation before are kept."""
        known, plain, ended, odd = self._known, set(), [], []
        for piece in pieces:
            if piece in self._older:
                known[piece] = self._older[piece]
                continue
            inner = piece[1:] if piece[:1] == "\n" else piece
            if not inner or inner[0].isspace() or inner[-1].isspace():
                known[piece] = None
                continue
            if piece[0] in ".,":
                odd.append(piece)
                continue
            core = self._cut_tail(piece)
            if core is not piece:
                ended.append((piece, core))
                if core in known or core in pieces:
                    continue
                if core in self._older:
                    known[core] = self._older[core]
                    continue
            plain.add(core)
        known.update(zip(odd, self.whole(odd), strict=True))
        self._encode_new([p if p[0] == "\n" else " " + p for p in plain])
        for piece, core in ended:
            tail = piece[len(core) :]
            if tail not in self._tails:
                self._tails[tail] = self.whole([tail])[0]
            known[piece] = known[core] + self._tails[tail]

    def _encode_new(self, plain: list[str]) -> None:
        size = np.dtype(self.width).itemsize
        for start in range(0, len(plain), TOGETHER):
            part = plain[start : start + TOGETHER]
            whole = self._tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0]
            ids = np.array(whole.ids, dtype=self.width)
            begins = np.flatnonzero(self._spaced[ids])
            names = [p.removeprefix(" ") for p in part]
            if len(begins) != len(part):
                self._known.update(zip(names, self.whole(part), strict=True))
                continue
            raw, ends = ids.tobytes(), np.append(begins[1:], len(ids)) * size
            self._known.update((p, raw[a:b]) for p, a, b in zip(names, (begins * size).tolist(), ends.tolist(), strict=True))

    def encode(self, texts: pa.StringArray) -> list[bytes]:
        """The ids of each text as packed integers of ``width``; no text may be NULL."""
        if len(self._known) > self._cached:
            self._older, self._known = self._known, {}
            self._first.clear()
            self._tails.clear()
        if not len(texts):
            return []
        parted = texts
        for mark in MARKS:
            parted = pc.replace_substring(parted, mark, " " + mark)
        cut = pc.split_pattern(parted, " ")
        offsets = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        codes, pieces, known = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist(), self._known
        stops = pc.match_substring_regex(coded.dictionary, r"^[.,]").to_numpy(zero_copy_only=False)
        closed = pc.match_substring_regex(coded.dictionary, r"[\p{L}\p{N}]$").to_numpy(zero_copy_only=False)
        joins = np.r_[False, stops[codes[1:]] & ~closed[codes[:-1]]]  # one run of punctuation
        self._learn({w for w in pieces if w not in known})
        heads = [pieces[c] for c in codes[offsets[:-1]]]
        new = list(set(heads).difference(self._first))
        self._first.update(zip(new, self.whole(new), strict=True))
        self._first.update((h, None) for h in new if not h or h[-1].isspace())
        found = [known[w] for w in pieces] + [self._first[h] for h in heads]
        codes[offsets[:-1]] = len(pieces) + np.arange(len(heads))
        alone = np.array([f is not None for f in found])
        sizes = np.array([len(f or b"") for f in found]) // np.dtype(self.width).itemsize
        ids = np.frombuffer(b"".join(f or b"" for f in found), self.width)
        plain = np.logical_and.reduceat(alone[codes] & ~joins, offsets[:-1])
        taken = sizes[codes]
        ends = np.cumsum(taken)
        at = np.repeat((np.cumsum(sizes)[codes] - ends).astype(np.int32), taken)
        at += np.arange(ends[-1], dtype=np.int32)
        joined = ids[at]
        bounds = np.r_[0, ends][offsets]
        out = [joined[x:y].tobytes() for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        rest = np.flatnonzero(~plain)
        if len(rest):
            for i, own in zip(rest.tolist(), self.whole(texts.take(pa.array(rest)).to_pylist()), strict=True):
                out[i] = own
        return out


def _pieces_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ``TEXT_AT_ONCE`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    groups = np.cumsum(sizes, dtype=np.int64) // TEXT_AT_ONCE
    cuts = np.r_[0, np.flatnonzero(np.diff(groups)) + 1, batch.num_rows]
    return (batch.slice(x, y - x) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True) if y > x)


def _tokenise(path: str, end_id: int, cached: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, cached)
        end = np.array([end_id], dtype=encoder.width).tobytes()
        for batch in batches:
            for part in _pieces_of(batch):
                ids = [x + end for x in encoder.encode(pc.fill_null(part.column("text"), ""))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])
        if not keep:
            _encoder.cache_clear()
            pa.default_memory_pool().release_unused()

    return run


def with_ids(docs: DataFrame, tokenizer: str, end_id: int = 0, cached: int = CACHE_PIECES, keep: bool = True) -> DataFrame:
    """``doc_id`` and ``ids``, the packed ids of the whole text and the end id.

    A task remembers up to twice ``cached`` pieces, of about 200 bytes each, and with ``keep`` leaves
    them to the next task of its worker.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(_tokenise(tokenizer, end_id, cached, keep), "doc_id long, ids binary"), "ids")


def _count(width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                ids = np.frombuffer(b"".join(batch.column("ids").slice(start, 256).to_pylist()), width)
                more = np.bincount(ids, minlength=len(total))
                more[: len(total)] += total
                total = more
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    return run


def code_lengths(counts: list[int], longest: int = LONGEST) -> list[int]:
    """Optimal code lengths of at most ``longest`` bits, by package-merge."""
    if len(counts) == 1:
        return [1]
    if len(counts) > 1 << longest:
        raise ValueError("more symbols than codes")
    order = np.argsort(np.array(counts), kind="stable")
    leaves = np.array(counts, dtype=np.float64)[order]
    weights, made = leaves, []
    for _ in range(longest - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        made.append(rank < len(leaves))
        weights = both[rank]
    lengths = np.zeros(len(counts), np.int64)
    take = 2 * len(counts) - 2
    for is_leaf in reversed(made):
        first = is_leaf[:take]
        lengths[order[: first.sum()]] += 1
        take = 2 * int((~first).sum())
    lengths[order[:take]] += 1
    return lengths.tolist()


class Code:
    """A canonical code: codes of one length are successive numbers, in the order of the ids."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = np.asarray(symbols)[order], np.asarray(lengths)[order]
        self.longest = int(self.lengths.max(initial=1))
        span = np.int64(1) << (self.longest - self.lengths)
        starts = np.cumsum(np.r_[0, span])[:-1]
        size = int(self.symbols.max(initial=0)) + 1
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.symbols] = starts >> (self.longest - self.lengths)
        self.length_of[self.symbols] = self.lengths
        self.table_symbol = np.repeat(self.symbols, span).astype(np.uint32)
        self.table_length = np.repeat(self.lengths, span).astype(np.int64)
        missing = (1 << self.longest) - len(self.table_symbol)
        if missing:
            self.table_symbol = np.r_[self.table_symbol, np.zeros(missing, np.uint32)]
            self.table_length = np.r_[self.table_length, np.zeros(missing, np.int64)]

    def encode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The code of documents that begin at ``starts``: bytes, byte offsets, bit offsets of all ids."""
        lengths = self.length_of[ids]
        total = np.cumsum(np.r_[0, lengths])
        bits = np.diff(np.r_[total[starts], total[-1]])
        size = (bits + 7) // 8
        at = np.cumsum(np.r_[0, size])
        docs = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
        offset = total[:-1] - total[starts][docs] + 8 * at[docs]
        code = self.code_of[ids]
        word, inside = offset >> 5, offset & 31
        placed = code << (64 - inside - lengths).astype(np.uint64)
        words = np.zeros(int(at[-1]) // 4 + 3, np.uint64)
        if len(ids):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sums = np.add.reduceat(placed, first)
            words[word[first]] += sums >> np.uint64(32)
            words[word[first] + 1] += sums & np.uint64(0xFFFFFFFF)
        return words.astype(">u4").tobytes()[: int(at[-1])], at, offset

    def decode(self, code: bytes, blocks: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The ids of blocks that begin at bits ``blocks`` and hold ``counts`` ids, all in step."""
        raw = np.frombuffer(code + bytes(8), np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        out = np.zeros(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, place, left = blocks[order].copy(), np.cumsum(np.r_[0, counts])[:-1][order], counts[order]
        shift = 32 - self.longest
        mask = (1 << self.longest) - 1
        active = len(left)
        for step in range(int(counts.max(initial=0))):
            while active and left[active - 1] <= step:
                active -= 1
            now = at[:active]
            look = (window[now >> 3] >> (shift - (now & 7)).astype(np.uint32)) & mask
            out[place[:active] + step] = self.table_symbol[look]
            at[:active] += self.table_length[look]
        return out

    def header(self) -> bytes:
        pairs = np.zeros(len(self.symbols), dtype=[("symbol", "<u4"), ("length", "u1")])
        pairs["symbol"], pairs["length"] = self.symbols, self.lengths
        return MAGIC + struct.pack("<BI", self.longest, len(pairs)) + pairs.tobytes()

    @classmethod
    def read(cls, stream) -> Code:
        lead = stream.read(len(MAGIC) + 5)
        if lead[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        _, n = struct.unpack("<BI", lead[len(MAGIC) :])
        pairs = np.frombuffer(stream.read(5 * n), dtype=[("symbol", "<u4"), ("length", "u1")])
        return cls(pairs["symbol"].astype(np.int64), pairs["length"].astype(np.int64))


def build_code(ids: DataFrame, width: str) -> Code:
    """The code for the counts of all ids; the driver sees one row per id of the vocabulary."""
    counts = ids.mapInArrow(_count(width), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").toArrow()
    symbols = counts.column("id").to_numpy()
    return Code(symbols, np.array(code_lengths(counts.column("n").to_pylist()) if len(symbols) else [], np.int64))


def document_bytes(code: Code, doc_ids: list[int | None], ids: list[np.ndarray]) -> list[bytes]:
    """The file's part for each document."""
    sizes = np.array([len(x) for x in ids])
    starts = np.cumsum(np.r_[0, sizes])[:-1]
    content, at, offset = code.encode(np.concatenate(ids).astype(np.int64), starts)
    out = []
    for i, doc in enumerate(doc_ids):
        marks = offset[starts[i] + BLOCK_IDS : starts[i] + sizes[i] : BLOCK_IDS] - 8 * at[i]
        own = content[at[i] : at[i + 1]]
        out.append(struct.pack("<qBI", doc or 0, doc is not None, sizes[i]) + marks.astype("<u4").tobytes() + struct.pack("<I", len(own)) + own)
    return out


def _groups(sizes: list[int]) -> Iterator[slice]:
    """Successive rows with about ``IDS_AT_ONCE`` ids."""
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= IDS_AT_ONCE:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def _coder(code: Code, width: str, bounds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            ranges = np.array([-1 if d is None else np.searchsorted(bounds, d) for d in docs], np.int32)
            ids = [np.frombuffer(x.as_buffer(), width) for x in batch.column("ids")]
            for rows in _groups([len(x) for x in ids]):
                parts = document_bytes(code, docs[rows], ids[rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ranges[rows]), pa.array(docs[rows], pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()), pa.array(parts, pa.binary())],
                    names=["range", "doc_id", "tie", "part"],
                )

    return run


def _file_writer(folder: str, header: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        attempt, made, out = uuid.uuid4().hex, [], None

        def close() -> None:
            out.close()
            made[-1][2:] = [docs, size]

        docs = size = 0
        for batch in batches:
            for number, part in zip(batch.column("range").to_pylist(), batch.column("part"), strict=True):
                if out is not None and (number != current or size >= ROLL_BYTES):
                    close()
                    out = None
                if out is None:
                    current = number
                    name = f"{number + 1:06d}-{len(made):04d}-{attempt}.ids"
                    out = files.open_output_stream(f"{path}/{name}")
                    out.write(header)
                    made.append([f"{folder}/{name}", number * 1_000_000 + len(made), 0, 0])
                    docs, size = 0, len(header)
                out.write(part.as_buffer())
                docs, size = docs + 1, size + len(part.as_buffer())
        if out is not None:
            close()
        columns = zip(*made, strict=True) if made else [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["path", "number", "docs", "bytes"])

    return run


def write_files(ids: DataFrame, width: str, folder: str) -> DataFrame:
    """Write files in ascending order of doc_id, NULL first; the manifest, ordered by ``number``.

    Each document is coded where it lies, so the shuffle by ranges of doc_id moves the code
    and not the ids. The ranges come from quantiles of doc_id; they only decide how the
    documents are dealt to files. Repeated doc_ids follow each other. The files of lost
    attempts have other names and are not in the manifest.
    """
    code = build_code(ids, width)
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = RANGES_PER_TASK * parts
    bounds = np.unique(ids.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges))
    coded = ids.mapInArrow(_coder(code, width, bounds), "range int, doc_id long, tie long, part binary")
    placed = coded.repartition(parts, "range").sortWithinPartitions("range", "doc_id", "tie")
    return stored(placed.mapInArrow(_file_writer(folder, code.header()), "path string, number long, docs long, bytes long"), "ids-manifest")


def _documents(stream) -> Iterator[tuple]:
    while lead := stream.read(13):
        doc, known, n = struct.unpack("<qBI", lead)
        marks = np.frombuffer(stream.read(4 * ((n - 1) // BLOCK_IDS) if n else 0), "<u4")
        (size,) = struct.unpack("<I", stream.read(4))
        own = stream.read(size)
        if len(own) != size:
            raise ValueError("code is cut off")
        yield (doc if known else None), n, marks, own


def decode_documents(code: Code, documents: list[tuple]) -> list[np.ndarray]:
    """The ids of documents as ``_documents`` gives them, all their blocks decoded in step."""
    base = np.cumsum([0, *(len(own) for *_, own in documents)])
    starts = [8 * base[i] + np.r_[0, marks].astype(np.int64) for i, (_, n, marks, _) in enumerate(documents) if n]
    counts = [np.append(np.full((n - 1) // BLOCK_IDS, BLOCK_IDS), (n - 1) % BLOCK_IDS + 1) for _, n, _, _ in documents if n]
    joined = b"".join(own for *_, own in documents)
    ids = code.decode(joined, np.concatenate(starts), np.concatenate(counts)) if starts else np.zeros(0, np.uint32)
    return np.split(ids, np.cumsum([n for _, n, _, _ in documents])[:-1])


def _file_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, number, expected in zip(*(batch.column(c).to_pylist() for c in ("path", "number", "docs")), strict=True):
            files, path = open_folder(uri.rpartition("/")[0])
            seen = before = 0
            with files.open_input_stream(f"{path}/{uri.rpartition('/')[2]}", buffer_size=1 << 20) as stream:
                code, held, size = Code.read(stream), [], 0
                source = _documents(stream)
                while True:
                    document = next(source, None)
                    if document is not None:
                        held.append(document)
                        size += document[1]
                    if held and (document is None or size >= IDS_AT_ONCE):
                        ids = decode_documents(code, held)
                        counts = np.array([n for _, n, _, _ in held])
                        start = before + np.cumsum(np.r_[0, counts])[:-1]
                        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([d[0] for d in held], pa.int64()), pa.array(np.full(len(held), number)), pa.array(start), pa.array(counts), pa.array(crc, pa.int64())],
                            names=["doc_id", "number", "start", "n_tokens", "ids_crc32"],
                        )
                        seen, before, held, size = seen + len(held), before + int(counts.sum()), [], 0
                    if document is None:
                        break
            if seen != expected:
                raise ValueError(f"{uri} has {seen} documents, the manifest says {expected}")


def read_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it in all files. It needs the number
    of ids per file, a table with a row per file.
    """
    parts = max(1, manifest.count())
    read = manifest.repartition(parts).mapInArrow(_file_reader, "doc_id long, number long, start long, n_tokens long, ids_crc32 long")
    read = stored(read, "read-ids")
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    files = read.groupBy("number").agg(F.sum("n_tokens").alias("_n"))
    offsets = files.select("number", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return read.join(F.broadcast(offsets), "number").select("doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, cached: int = CACHE_PIECES, keep: bool = True) -> DataFrame:
    """Tokenise ``docs``, write the ids to files in a new shared folder and read them back.

    Every row is written, repeated ones too; NULL and empty texts hold the end id alone.
    """
    width = PieceEncoder(tokenizer).width
    ids = with_ids(docs, tokenizer, cached=cached, keep=keep)
    return read_files(write_files(ids, width, shared_folder(docs.sparkSession, "token-files")))
