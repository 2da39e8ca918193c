"""Byte-level BPE, fill-in-middle and token alignment against the libraries and plain code."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from triploom.llm import align, byte_bpe, coded_blocks, fill_in_middle, pretokens
from triploom.llm.queries import QUERIES
from triploom.llm.storage import reach_workers

SF_DIR = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = "doc_id long, text string, ids string, n string, block string, part string, code string, words string, form string, n_a string, frames string, first string"
SIGNS = [*"  '''sstmdrevelaB5\n\t\r .,-!é", "²", "½", " ", " ", "漢", "\U0001f600", "́", "\x1c", "\u0085", "٣", "<P>", "<|endoftext|>", "<s>"]


def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(4)
    one = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300))
    rows = [
        (1, None), (2, ""), (3, " "), (4, "  \n\t "), (5, one), (5, one), (5, one + "."), (None, one), (None, "x"), (6, "word " * 9_000),
        (7, "a" * 5_000), (8, "it's we're you'll 'd ''s 's \n's"), (9, "a<|endoftext|> b <s> c </s>"), (10, "one▁two"), (11, "trailing  "), (12, " \x00 nul"),
        (13, "x <P> y"), (14, "<S"), (15, "a < b S> <M"), (16, "é" * 40_000),
    ]
    return rows + [(100 + i, "".join(rng.choices(SIGNS, k=rng.randint(0, 40)))) for i in range(400)]


def odd_docs(spark):
    reach_workers(spark)
    return spark.createDataFrame([(i, t, *["x"] * 10) for i, t in odd_texts()], CLASHES).repartition(3)


def no_docs(spark):
    reach_workers(spark)
    return spark.createDataFrame([], CLASHES)


def given_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def same_rows(rows, expected):
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


# --- pre-tokens ----------------------------------------------------------------------------


def test_classes_agree_with_both_libraries():
    kinds = pretokens.classes()
    split = Tokenizer.from_file(BYTE_BPE).pre_tokenizer.pre_tokenize_str
    for at in [*range(0x3000), *range(0xFF00, 0x10000), *range(0x1D7C0, 0x1D800), 0x1F600, 0x20000]:
        sign = chr(at)
        after_letter, between_marks = len(split("a" + sign)) == 1, len(split("!" + sign + "!")) == 1
        after_number = sign != " " and len(split("1" + sign)) == 1
        expected = pretokens.LETTER if after_letter else pretokens.NUMBER if after_number else pretokens.OTHER if between_marks else pretokens.SPACE
        assert kinds[at] == expected, hex(at)


@pytest.mark.parametrize("limit", [7, 200, 1 << 20])
def test_pieces_are_the_matches_of_the_pattern(limit):
    rng = random.Random(limit)
    texts = [None, "", *("".join(rng.choices(SIGNS, k=rng.randint(0, 30))) for _ in range(3_000))]
    found = [[] for _ in texts]
    for chunk in pretokens.chunked(pa.array(texts), limit):
        got, at = pretokens.pieces(chunk)
        for place, x, y in zip(chunk.rows, at[:-1], at[1:], strict=True):
            found[place] += got[x:y].to_pylist()
    assert [b"".join(f).decode() for f in found] == [t or "" for t in texts]
    # the regex module knows other letters than tiktoken in newer planes, but none of these
    assert [[p.decode() for p in f] for f in found] == [regex.findall(public_tokenizers.PATTERN, t or "") for t in texts]


def test_chunks_hold_whole_texts_or_parts():
    texts = ["a b", "c" * 50, "long words " * 30, "", None, "end"]
    chunks = list(pretokens.chunked(pa.array(texts), 40))
    joined = defaultdict(bytes)
    for chunk in chunks:
        for place, x, y in zip(chunk.rows, chunk.bounds[:-1], chunk.bounds[1:], strict=True):
            joined[place] += chunk.data[x:y]
    assert [joined[i].decode() for i in range(len(texts))] == [t or "" for t in texts]
    assert any(c.part > 3 for c in chunks) and all(len(c.data) <= 52 for c in chunks)


def test_packed_numbers_come_back():
    for numbers in ([], [0], [65535, 1], [65536, 3, 1 << 31]):
        assert coded_blocks.unpacked(coded_blocks.packed(np.array(numbers, np.int64))).tolist() == numbers
    words = [b"", b"a", b"\xff" * 70_000]
    assert byte_bpe.unpack_words(byte_bpe.pack_words(words)) == words
    assert byte_bpe.unpack_words(byte_bpe.pack_words([])) == []


# --- byte-level BPE ------------------------------------------------------------------------


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 3_000, "chunk_bytes": 1_000}])
def test_ids_equal_the_library_and_decode_back(spark, sizes):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS), special_tokens={})
    rows = byte_bpe.decoded(byte_bpe.encoded(odd_docs(spark), RANKS, **sizes), RANKS)
    assert rows.columns == ["doc_id", "ids", "decoded"]
    expected = [(i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in odd_texts()]
    same_rows([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in rows.collect()], expected)


def test_bpe_query_on_the_given_table(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(RANKS), special_tokens={})
    expected = []
    for i, t in given_docs(spark):
        ids = library.encode_ordinary(t or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    rows = QUERIES["op11_byte_bpe"](spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    same_rows(rows.collect(), expected)


def test_bpe_of_nothing(spark):
    assert byte_bpe.decoded(byte_bpe.encoded(no_docs(spark), RANKS), RANKS).collect() == []
    ids = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert [bytes(r.decoded) for r in byte_bpe.decoded(ids, RANKS).collect()] == [b"", b""]


def test_unknown_ids_raise(spark):
    ids = spark.createDataFrame([(1, np.array([60_000], "<u4").tobytes())], "doc_id long, ids binary")
    with pytest.raises(Exception, match="IndexError"):
        byte_bpe.decoded(ids, RANKS).collect()


# --- fill in the middle --------------------------------------------------------------------


def plain_transform(doc_id, text, seed=42, plain=50, spm=80):
    text = text or ""
    units = regex.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= plain:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    form = "spm" if h4 % 100 < spm else "psm"
    made = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), made


@pytest.mark.parametrize("options", [{}, {"seed": 7, "plain": 100, "spm": 50}])
def test_fill_in_middle_equals_plain_code(spark, options):
    docs = odd_docs(spark)
    expected = [(i, *plain_transform(i, t, **options), t or "") for i, t in odd_texts()]
    assert {e[2] for e in expected} == {"plain", "spm", "psm"}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = fill_in_middle.digests(docs, **options).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    same_rows(rows.collect(), [(*e[:5], sha(e[5]), sha(e[6])) for e in expected])
    rows = fill_in_middle.outputs(docs, **options).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    same_rows(rows.collect(), [e[:6] for e in expected])


def test_fill_in_middle_of_nothing(spark):
    assert fill_in_middle.digests(no_docs(spark)).collect() == []


def test_cuts_read_one_frame_and_marks_are_found_across_frames(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "FRAME_BYTES", 5)
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choices([*"ab  \n<PSM>é", "漢"], k=rng.randint(1, 60)))
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        units = regex.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        row = fill_in_middle.frames_of(text.encode())
        assert row["n"] == len(units)
        frames = fill_in_middle.Frames(row["frames"], row["ends"])
        opened, frame = [], frames.frame
        frames.frame = lambda i, o=opened, f=frame: o.append(i) or f(i)
        cuts = []
        for unit in sorted((rng.randint(0, len(units)), rng.randint(0, len(units)))):
            opened.clear()
            cuts.append(fill_in_middle.cut_at(frames, row["units"], row["chars"], row["opens"], unit))
            assert len(opened) <= 1
            assert text[: cuts[-1][1]] == "".join(units[:unit]) == text.encode()[: cuts[-1][0]].decode()
        for form in fill_in_middle.ORDERS:
            made = fill_in_middle.reframed(fill_in_middle.output(frames, form, cuts[0][0], cuts[1][0]))
            assert b"".join(fill_in_middle.restored(made, form)).decode() == text


# --- alignment -----------------------------------------------------------------------------


def plain_alignment(docs):
    """Groups and links of every text by plain loops over the libraries' tokens of the whole text."""
    a_library = Tokenizer.from_file(BYTE_BPE)
    a_library.encode_special_tokens = True
    b_library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    signs, names = align.byte_of_sign(), {i: t for t, i in a_library.get_vocab().items()}

    def placed(parts):
        at, out = 0, []
        for part in parts:
            out.append((at, at + len(part)))
            at += len(part)
        return out

    def piece(i):
        name = b_library.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b_library.is_byte(i) else name.replace("▁", " ").encode()

    found, holders = [], Counter()
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        a_ids = a_library.encode(whole.decode(), add_special_tokens=False).ids
        b_ids = b_library.encode(text or "")
        a_bytes, b_bytes = [bytes(signs[c] for c in names[i]) for i in a_ids], [piece(i) for i in b_ids]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append((doc_id, None))
            continue
        a_spans, b_spans = placed(a_bytes), placed(b_bytes)
        links, j = [], 0
        for i, (start, end) in enumerate(a_spans):
            while b_spans[j][1] <= start:
                j += 1
            k = j
            while k < len(b_spans) and b_spans[k][0] < end:
                links.append((a_ids[i], b_ids[k]))
                k += 1
        groups = []
        for end in sorted({e for _, e in a_spans} & {e for _, e in b_spans}):
            taken = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups)
            own = [], []
            for side, (ids, spans) in enumerate(((a_ids, a_spans), (b_ids, b_spans))):
                for i in range(taken[side], len(ids)):
                    if spans[i][1] > end:
                        break
                    own[side].append(ids[i])
            groups.append(own)
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        holders.update(set(links))
        found.append((doc_id, (len(a_ids), len(b_ids), len(groups), links, hashlib.sha256(told.encode()).hexdigest())))
    most = defaultdict(int)
    for (a, _), n in holders.items():
        most[a] = max(most[a], n)
    return [
        (i, 0, 0, 0, 0, 0, 0, "") if f is None else (i, *f[:3], len(f[3]), sum(holders[p] == most[p[0]] for p in f[3]), sum(holders[p] for p in f[3]), f[4])
        for i, f in found
    ]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 3_000, "chunk_bytes": 1_000}])
def test_alignment_equals_plain_loops(spark, sizes):
    texts = [(i, t) for i, t in odd_texts() if len(t or "") < 10_000] + [(17, "word's end  " * 400)]
    reach_workers(spark)
    docs = spark.createDataFrame([(i, t, *["x"] * 10) for i, t in texts], CLASHES).repartition(3)
    rows = align.aligned(docs, BYTE_BPE, PIECE_BPE, **sizes)
    found = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    expected = plain_alignment(texts)
    assert sum(e[1] == 0 for e in expected) >= 5
    same_rows(found, expected)


def test_alignment_query_on_the_given_table(spark):
    rows = QUERIES["op13_token_alignment"](spark, SF_DIR)
    found = rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    same_rows(found, plain_alignment(given_docs(spark)))


def test_alignment_of_many_texts_takes_little_memory_at_once():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 9))) for _ in range(20_000)]
    texts = pa.array([" " + " ".join(rng.choices(words, k=5_000)) for _ in range(160)])
    a, b = align.byte_level(BYTE_BPE), align.piecewise(PIECE_BPE)
    pretokens.classes()
    most = 0
    for chunk in pretokens.chunked(texts, align.CHUNK_BYTES):
        tracemalloc.start()
        assert sum(1 for _ in align._parts(a, b, chunk)) == len(chunk.rows)
        most = max(most, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert most < 250 << 20


def test_alignment_of_a_text_in_many_parts_keeps_few_lists_of_pairs():
    begun, parts = align._Texts(), 5 * align.MERGED_PARTS
    for i in range(parts):
        begun.add(np.ones(4, np.int64), memoryview(b"x"), (np.array([1, 2 + i % 2]), np.array([3, 1])), False)
        assert len(begun.pairs) <= align.MERGED_PARTS
    _, pairs, times = begun.row()
    assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == {1: 3 * parts, 2: parts // 2, 3: parts // 2}


def test_alignment_of_long_texts_and_of_nothing(spark):
    assert align.aligned(no_docs(spark), BYTE_BPE, PIECE_BPE).collect() == []
    reach_workers(spark)
    text = "several words, again and again. " * 3_000
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    whole = align.aligned(docs, BYTE_BPE, PIECE_BPE).collect()
    same_rows(align.aligned(docs, BYTE_BPE, PIECE_BPE, chunk_bytes=5_000).collect(), list(map(tuple, whole)))


def test_groups_close_where_both_sides_end():
    a, b = np.array([2, 3, 7, 9]), np.array([1, 3, 4, 9])
    groups = align.groups_of(a, b)
    assert groups[0].tolist() == [0, 0, 1, 1] and groups[1].tolist() == [0, 0, 1, 1]
    assert list(zip(*(x.tolist() for x in align.links_of(a, b)), strict=True)) == [(0, 0), (0, 1), (1, 1), (2, 2), (2, 3), (3, 3)]
    none = np.zeros(0, np.int64)
    assert [len(x) for x in (*align.groups_of(none, none), *align.links_of(none, none))] == [0, 0, 0, 0]
