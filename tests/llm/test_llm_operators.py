"""Each operator against a brute-force version, and on odd input."""

from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triploom.llm import components, decontaminate, hnsw, huffman, linear, mixing, packing, quality, simhash_dups, suffix_dups, token_cache, warc
from triploom.llm.queries import DOMAINS, WEIGHTS
from triploom.llm.ranks import gapless
from triploom.llm.storage import shared_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = "doc_id long, text string, size string, fp string, start string, rank string, copies string, tokens string, root string, shard string, slot string, n_bytes string, _text string, at string, quality_score string"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(words))


def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    one = sentence(rng, 130)
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, one), (5, one), (5, one), (6, one + " tail"),
        (7, "word " * 9_000), (8, "é ü ñ  two  spaces \n x y"), (9, "a<|endoftext|> b <s> c"), (None, one), (10, "short text"), (11, " leading"),
    ]


def odd_docs(spark):
    return spark.createDataFrame([(i, t, *["x"] * 13) for i, t in odd_texts()], CLASHES)


def no_docs(spark):
    return spark.createDataFrame([], CLASHES)


# --- helpers -------------------------------------------------------------------------------


def test_components_match_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(400, 480)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = components.components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["root"] for r in got} == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_gapless_ranks(spark):
    rows = [(g, i) for i in range(300) for g in ("a", None, "b") if g != "b" or i % 50 == 0]
    got = gapless(spark.createDataFrame(rows, "g string, i long"), "g", ["i"], "rank").collect()
    for group in ("a", None, "b"):
        own = sorted((r["rank"], r["i"]) for r in got if r["g"] == group)
        assert [r for r, _ in own] == list(range(len(own))) and [i for _, i in own] == sorted(i for _, i in own)


# --- 1 -------------------------------------------------------------------------------------


def brute_matches(docs, items, shingle=5, least=0.8):
    found = {}
    for item_id, item in items:
        words = (item or "").lower().split()
        k = min(shingle, len(words))
        own = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] if k else []
        for doc_id, text in docs:
            tokens = (text or "").lower().split()
            grams = [tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1)] if k else []
            for start in range(max(1, len(grams) - len(own) + 1)):
                window = Counter(grams[start : start + len(own)])
                shared = sum((window & Counter(own)).values())
                if own and grams and shared / (window.total() + len(own) - shared) >= least:
                    found.setdefault((doc_id, item_id), 0.0)
                    found[doc_id, item_id] = max(found[doc_id, item_id], shared / (window.total() + len(own) - shared))
    return {k: round(v, 9) for k, v in found.items()}


def test_decontamination_matches_all_windows(spark):
    rng = random.Random(3)
    items = [(i, sentence(rng, rng.choice([3, 9, 30, 31, 60]))) for i in range(20)] + [(30, None), (31, ""), (32, "same same same same same same same same")]
    docs = []
    for i in range(60):
        body = sentence(rng, 40).split()
        passage = items[i % 20][1].split()
        if i % 3 and len(passage) > 20:
            passage[rng.randrange(len(passage))] = "changed"
        if i % 4 == 0 and len(passage) > 20:
            passage.insert(len(passage) // 2, "more")
        docs.append((i, " ".join([*body[: i % 40], *passage, *body[i % 40 :]]).upper()))
    docs += [(100, None), (101, ""), (102, items[2][1]), (103, "same " * 40), (104, items[0][1]), (104, items[0][1])]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got.collect()} == brute_matches(docs, items)


def test_windows_between_aligned_starts_are_laid(spark):
    """Both ends edited and words inserted: the best window is at no shared shingle's offset. Or the halves swapped."""
    rng = random.Random(8)
    items, docs = [], []
    for i in range(6):
        words = sentence(rng, 59).split()
        items.append((i, " ".join(words)))
        edited = ["first", *words[1:29], "one", "two", *words[29:-1], "last"]
        docs.append((2 * i, " ".join([*sentence(rng, 3 * i).split(), *edited, *sentence(rng, 9).split()])))
        docs.append((2 * i + 1, " ".join([*sentence(rng, 4).split(), *words[30:], *words[:30], "end"])))
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = brute_matches(docs, items)
    assert len(expected) == 12
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got.collect()} == expected


def test_decontamination_odd_input(spark):
    docs, items = odd_docs(spark), spark.createDataFrame([(1, "short text", 0), (2, None, 0)], "item_id long, text string, doc_id int")
    assert [(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, items).collect()] == [(10, 1)]
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontaminate.matches(docs, items.limit(0)).count() == 0 == decontaminate.matches(no_docs(spark), items).count()


def test_decontamination_runs_no_python(spark):
    docs = odd_docs(spark)
    plan = decontaminate.matches(docs, spark.createDataFrame([(1, "short text")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_simhash_blocks_find_all_within_radius():
    rng = random.Random(4)
    ends = [64 * i // 21 for i in range(22)]
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 20):
            b ^= 1 << bit
        assert any((a ^ b) >> s & ((1 << (e - s)) - 1) == 0 for s, e in zip(ends, ends[1:], strict=False))


# --- 2 -------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    big = "<p>" + "long " * 400_000
    pages = [(5, "http://a/ b", "x"), (3, None, "x"), (3, "http://c", "x"), (9, "u", None), (8, "u", ""), (None, "n", "x"), (None, "n", "only"), (7, "ü", "é" * 50), (6, "b", big)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, _first int")
    manifest = warc.write_archives(df, shared_folder(spark, "t"))
    got = {(r["page_id"], r["payload_digest"]): r for r in warc.read_archives(manifest).collect()}
    assert warc.read_archives(manifest).count() == len(pages) == sum(r["records"] for r in manifest.collect())
    for page_id, _, html in pages:
        payload = (html or "").encode()
        row = got[page_id, base64.b32encode(hashlib.sha1(payload).digest()).decode()]
        first = min((p for p, _, h in pages if (h or "") == (html or "") and p is not None), default=None)
        assert row["payload_bytes"] == len(payload)
        assert (row["record_type"], row["refers_to"]) == (("response", None) if first in (None, page_id) else ("revisit", first))
        assert row["payload"] == (bytearray(payload) if row["record_type"] == "response" else None)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_urls_come_back_as_they_were(spark):
    urls = ["http://a/b  c\x1c d", " lead", "trail\t", "x%20y", "a b%20c%", "ü ä\u00a0ö", "", None, "http://plain/?q=1#f", "line\r\nbreak: x", "\x00"]
    pages = [(i, u, f"page {i % 4}") for i, u in enumerate(urls)]
    manifest = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), shared_folder(spark, "t"))
    assert {r["page_id"]: r["url"] for r in warc.read_archives(manifest).collect()} == dict(enumerate(urls))


@pytest.mark.parametrize("change", ["cut", "length", "digest", "magic", "header", "type"])
def test_warc_reader_rejects(change):
    record = warc.record_bytes(1, "http://a", b"payload", None)
    changed = {
        "length": record.replace(b"Content-Length: 7", b"Content-Length: 8"),
        "digest": record.replace(b"payload\r\n", b"payloaD\r\n"),
        "header": record.replace(b"WARC-Type: response\r\n", b""),
        "type": record.replace(b"WARC-Type: response", b"WARC-Type: strange"),
    }.get(change, record)
    frames = warc.dictionary_frame(b"some dictionary text") + zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(b"some dictionary text")).compress(changed)
    if change == "cut":
        frames = frames[:-3]
    if change == "magic":
        frames = b"\0" + frames[1:]
    with pytest.raises(warc.WarcError):
        [warc.parse_record(r) for r in warc.records_of(io.BytesIO(frames))]


# --- 3 -------------------------------------------------------------------------------------


def test_rates_meet_targets_and_stay_nonnegative(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 3_000)
    tokens = rng.integers(1, 500, 3_000).astype(float)
    members = spark.createDataFrame([(float(t), x.tolist()) for t, x in zip(tokens, p, strict=True)], "tokens double, posteriors array<double>")
    targets = tokens.sum() * np.array([0.85, 0.1, 0.05])
    steps = mixing.fit_rates(members, targets)
    rates = mixing.rates_of(p, steps)
    assert rates.min() == 0
    assert np.allclose((rates * tokens) @ p, targets, rtol=1e-4)


def test_mixing_odd_input(spark):
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (9, 0, 1), (9, 1, 1), (None, 1, 0), (10, None, 0)], "doc_id long, quality int, toxic int")
    docs = odd_docs(spark)
    rated = mixing.with_rates(docs, labels, DOMAINS, WEIGHTS)
    rows = rated.collect()
    assert len(rows) == docs.count() and all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) <= 1 for r in rows)
    assert mixing.mixed(docs, labels, DOMAINS, WEIGHTS).columns == docs.columns
    assert {r["copies"] for r in mixing.with_rates(docs, labels.limit(0), DOMAINS, WEIGHTS).collect()} == {1}
    assert mixing.with_rates(no_docs(spark), labels, DOMAINS, WEIGHTS).count() == 0


@pytest.mark.parametrize("rare", [6, 30])
@pytest.mark.parametrize("weights", [{"a": 0.95, "b": 0.05}, {"a": 0.5, "b": 0.5}, {"a": 1.0}])
def test_totals_equal_weights_whatever_the_domains_share(spark, rare, weights):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["red", "rose", "rust"] if i < rare else ["blue", "bay", "bee"]) for _ in range(60))) for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "b" if i < rare else "a") for i in range(2_000)], "doc_id long, kind string")
    found = mixing.with_rates(docs, labels, "kind", weights).collect()
    p, tokens, rates = (np.array([r[c] for r in found]) for c in ("posteriors", "tokens", "rate"))
    present = tokens @ p
    assert present[1] < 0.05 * present.sum()
    if rare == 6:
        assert present[1] < 0.01 * present.sum()
    assert np.allclose((rates * tokens) @ p / tokens.sum(), [weights.get(n, 0) for n in "ab"], atol=2e-3)


def test_targets_out_of_reach_keep_the_budget(spark):
    rng = np.random.default_rng(4)
    faint = rng.uniform(0, 0.003, 2_000)
    p = np.stack([faint, 1 - faint], axis=1)
    members = spark.createDataFrame([(100.0, x.tolist()) for x in p], "tokens double, posteriors array<double>")
    totals = (mixing.rates_of(p, mixing.fit_rates(members, 2e5 * np.array([0.05, 0.95]))) * 100) @ p / 2e5
    assert abs(totals[1] - 0.95) < 1e-3 and 0.0025 < totals[0] < 0.003


def test_domain_classifier_holds_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fitted = labels.filter("doc_id % 3 > 0")
    model, names = mixing.fit_domains(docs, fitted, DOMAINS)
    held = labels.filter("doc_id % 3 = 0").join(docs, "doc_id").selectExpr(f"{DOMAINS} as domain", "text").collect()
    found = [names[i] for i in model.posteriors([r["text"].encode() for r in held]).argmax(axis=1)]
    right = [f == r["domain"] for f, r in zip(found, held, strict=True)]
    assert np.mean(right) > 0.9


# --- 4 -------------------------------------------------------------------------------------


def test_token_cache_counts_and_reuse(spark, monkeypatch):
    cache = shared_folder(spark, "t")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    docs = odd_docs(spark)
    got = token_cache.token_counts(docs, cache, PIECE_BPE, 4096).collect()
    expected = sorted((-1 if i is None else i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in odd_texts())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got) and any(r["over_limit"] for r in got)
    files = spark.read.parquet(cache).count()
    assert files == len({t or "" for _, t in odd_texts()})
    more = spark.createDataFrame([(50, "new text"), (51, "short text")], "doc_id long, text string")
    assert token_cache.token_counts(more, cache, PIECE_BPE, 1).count() == 2
    assert spark.read.parquet(cache).count() == files + 1
    spark.createDataFrame([(hashlib.sha256(b"planted").hexdigest(), token_cache.tokenizer_version(PIECE_BPE), 77)], token_cache.CACHE_SCHEMA).write.mode("append").parquet(cache)
    hit = token_cache.token_counts(spark.createDataFrame([(1, "planted")], "doc_id long, text string"), cache, PIECE_BPE, 1).first()
    assert hit["n_tokens"] == 77
    assert token_cache.token_counts(no_docs(spark), cache, PIECE_BPE, 1).count() == 0


# --- 5 -------------------------------------------------------------------------------------


def brute_nearest(rows, asked, k):
    found = {}
    for q, v in asked:
        scores = sorted((-float(np.dot(np.array(v), np.array(x))), i) for i, x in rows if i != q and len(x) == len(v))
        found[q] = [i for _, i in scores[:k]]
    return found


def test_hnsw_recall_on_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    got = defaultdict(list)
    for r in hnsw.nearest(vectors, "vec_id", "embedding", "id % 20 = 0", 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    truth = brute_nearest(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    assert got.keys() == truth.keys() and all(len(x) == 20 for x in got.values())
    assert np.mean([len(set(got[q]) & set(t)) / 20 for q, t in truth.items()]) >= 0.9


def test_hnsw_odd_input(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(30)] + [(i, [3.0, 1.0, 0.0, 0.5]) for i in range(40, 120)]
    odd = [(200, None), (220, []), (240, [0.0] * 4), (260, [float("nan")] + [1.0] * 3), (280, [None, 1.0, 1.0, 1.0]), (None, [1.0] * 4), (300, [float("inf")] * 4), (320, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in [*rows, *odd, rows[3]]], "vec_id long, embedding array<float>, rank string, shard string")
    got = defaultdict(list)
    for r in hnsw.nearest(df, "vec_id", "embedding", "id % 20 = 0", 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
        assert r["rank"] == len(got[r["query_id"]])
    single = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert dict(got) == brute_nearest(single, [(i, v) for i, v in single if i % 20 == 0], 20)
    assert hnsw.nearest(df.limit(0), "vec_id", "embedding", "id % 20 = 0", 20).count() == 0


def test_hnsw_recall_with_norms_far_apart(spark):
    """Norms over six powers of ten: the small vectors must not drown in the added component."""
    rng = np.random.default_rng(9)
    points = rng.normal(size=(1_500, 24))
    points /= np.linalg.norm(points, axis=1)[:, None]
    points[::100] *= np.logspace(-2, 4, 15)[:, None]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in hnsw.nearest(df, "vec_id", "embedding", "id % 20 = 0", 20).collect():
        found[r["query_id"]].add(r["vec_id"])
    scores = points @ points.T
    np.fill_diagonal(scores, -np.inf)
    hits = [len(found[q] & set(np.argsort(-scores[q])[:20].tolist())) for q in range(0, 1_500, 20)]
    assert sum(hits) / (20 * len(hits)) >= 0.9


def test_hnsw_dump_and_load():
    points = np.random.default_rng(3).normal(size=(400, 8))
    graph = hnsw.Graph(points)
    again, extra = hnsw.Graph.load(graph.dump(reps=np.arange(400)))
    assert graph.nearest(points[7].astype(np.float32), 5) == again.nearest(points[7].astype(np.float32), 5) and extra["reps"][9] == 9


# --- 6 -------------------------------------------------------------------------------------


def test_token_files_round_trip(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    texts = odd_texts()
    expected, start = [], 0
    for i, t in sorted(texts, key=lambda x: (x[0] is not None, x[0])):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = huffman.round_trip(odd_docs(spark), BYTE_BPE)
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got.collect()) == [(s, i, n, c) for i, s, n, c in expected]
    assert huffman.round_trip(no_docs(spark), BYTE_BPE).count() == 0


def test_piece_encoder_equals_library(spark):
    library, encoder = Tokenizer.from_file(BYTE_BPE), huffman.PieceEncoder(BYTE_BPE)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += [t or "" for _, t in odd_texts()] + [" ", "  ", "a ", " a", "a  b", "a \n b", "x​ y", "it's 12 o'clock , ok ...", "\x1c a \x1f b", "tab\t here", "a\u0085 b"]
    for seed in range(400):
        rng = random.Random(seed)
        texts.append("".join(rng.choices(["bc", ".", ",", "'", "''", "..", "&&&", "d.", "e2", "3.", "ñ!", "ǅ", "-", "'ll", " f", "<|", "endoftext", "|>", "\n", " "], k=14)))
        texts.append("".join(rng.choices(["a", "B", " ", "  ", "\n", ".", "'s", "é", "1", " ", "<|endoftext|>", "!", "\t", "漢", "　"], k=12)))
    got = encoder.encode(pa.array(texts))
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, encoder.width).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("counts", [[1], [5, 1], [1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 4181, 6765], [1] * 300, list(range(1, 2000))])
def test_code_lengths_are_optimal_within_limit(counts):
    lengths = huffman.code_lengths(counts)
    assert max(lengths) <= huffman.LONGEST and sum(2.0**-x for x in lengths) <= 1
    import heapq

    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        low = heapq.heappop(heap) + heapq.heappop(heap)
        cost += low
        heapq.heappush(heap, low)
    total = sum(c * x for c, x in zip(counts, lengths, strict=True))
    if len(counts) > 1:
        assert total == cost if max(lengths) < huffman.LONGEST else cost <= total <= cost * 1.01


def test_blocks_decode_independently():
    rng = np.random.default_rng(4)
    ids = rng.zipf(1.4, 5_000).clip(0, 900)
    symbols, counts = np.unique(ids, return_counts=True)
    code = huffman.Code(symbols, np.array(huffman.code_lengths(counts.tolist())))
    content, at, offset = code.encode(ids, np.array([0]))
    for start in range(0, 5_000, 256):
        n = min(256, 5_000 - start)
        assert code.decode(content, np.array([offset[start]]), np.array([n])).tolist() == ids[start : start + n].tolist()
    assert at[-1] == len(content)


# --- 7 -------------------------------------------------------------------------------------


def test_quality_on_held_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model, _ = quality.fit_quality(docs)
    scored = quality.with_quality(docs, model).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
    share = {(r["quality"], r["ok"]): r["count"] for r in scored.groupBy("quality", (F.col("quality_score") >= 0.5).alias("ok")).count().collect()}
    kept = share[1, True] / (share[1, True] + share.get((1, False), 0))
    caught = share[0, False] / (share[0, False] + share.get((0, True), 0))
    assert kept > 0.99 and caught > 0.9


def test_expectation_maximisation_finds_faults():
    rng = np.random.default_rng(5)
    n, labellers = 20_000, len(quality.LABELLERS)
    fault = np.where(rng.random(n) < 0.7, -1, rng.integers(0, labellers, n))
    spots = np.where(np.arange(labellers) == fault[:, None], rng.random((n, labellers)) < 0.95, rng.random((n, labellers)) < 0.1 * (fault >= 0)[:, None])
    vote = np.where(spots, quality.BAD, quality.GOOD)
    vote = np.where(rng.random((n, labellers)) < 0.05, quality.NONE, vote)
    patterns, at, counts = np.unique((vote * 3 ** np.arange(labellers)).sum(axis=1), return_inverse=True, return_counts=True)
    posterior, right, prior = quality.expectation_maximisation(patterns, counts)
    assert abs(prior - 0.7) < 0.03
    assert np.mean((posterior[at] >= 0.5) == (fault < 0)) > 0.97
    assert np.abs(right[:, 0] - [spots[fault >= 0, i].mean() for i in range(labellers)]).max() < 0.05
    assert right[:, 1].min() > 0.99


def test_quality_odd_input(spark):
    docs = odd_docs(spark)
    model, labelled = quality.fit_quality(docs)
    rows = quality.with_quality(docs, model)
    assert set(rows.columns) == set(docs.columns) and rows.count() == docs.count() == labelled.count()
    scores = {r["doc_id"]: r["quality_score"] for r in rows.collect()}
    assert scores[1] == scores[2] == scores[3] == 0
    assert quality.accepted(docs).columns == docs.columns
    assert quality.accepted(no_docs(spark)).count() == 0


def test_sample_features_takes_one_row_per_id(spark):
    docs = spark.createDataFrame([*[(1, f"text {i}") for i in range(50)], (2, "other"), (3, None), (4, "out")], "doc_id long, text string")
    sample = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, 0.0)], "doc_id long, weak_label double")
    rows = {r["doc_id"]: r["slots"] for r in linear.sample_features(docs, sample, form=True).to_pylist()}
    found = linear.sample_features(docs, sample, form=True)
    assert found.num_rows == 3 and found.column_names == ["doc_id", "weak_label", "slots"]
    chosen = min((f"text {i}".encode() for i in range(50)), key=lambda x: hashlib.md5(x).hexdigest())
    assert sorted(rows[1]) == sorted(linear.features(chosen).tolist())


def test_linear_fit_separates():
    rows = [linear.features(f"{'bad' if i % 2 else 'fine'} w{i % 7}".encode()) for i in range(200)]
    model = linear.fit(rows, np.array([[i % 2, 1 - i % 2] for i in range(200)], float), form=True)
    assert model.posteriors([b"bad w1", b"fine w9", None])[:, 0].round()[:2].tolist() == [1, 0]


# --- 8 -------------------------------------------------------------------------------------


def test_shards_follow_the_law(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.sharded(docs, 24).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    total, slots, shard_of = Counter(), defaultdict(list), {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw)
        total[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert shard_of.setdefault(raw, r["shard"]) == r["shard"]
    assert set(total) == set(range(24)) and max(total.values()) < 1.01 * sum(total.values()) / 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_best_fit_is_what_single_placing_gives():
    rng = random.Random(6)
    for _ in range(40):
        sizes = sorted({rng.randint(0, 60) for _ in range(12)}, reverse=True)
        counts = [rng.randint(1, 9) for _ in sizes]
        room, used = [], []
        for size, count in zip(sizes, counts, strict=True):
            for _ in range(count):
                fits = [(r, i) for i, r in enumerate(room) if r >= size]
                if not fits:
                    room.append(max(50, size))
                    used.append(0)
                    fits = [(room[-1], len(room) - 1)]
                room[min(fits)[1]] -= size
                used[min(fits)[1]] += size
        left = defaultdict(int)
        for i, number, fit in packing.best_fit(sizes, counts, 50):
            left[number] += fit * sizes[i]
        assert sorted(left.values()) == sorted(used)


def test_no_shard_exceeds_a_capacity(spark):
    rng = random.Random(16)
    sizes = [rng.randrange(1 << 20, 2 << 20) for _ in range(1_500)] + [20 << 20]
    groups = spark.createDataFrame(list(enumerate(sizes)), "name long, bytes long")
    filled = Counter()
    for r in packing.packed_groups(groups, "bytes", ["name"], capacity=16 << 20).collect():
        filled[r["shard"]] += r["bytes"]
    assert sorted(filled.values())[-1] == 20 << 20 and sorted(filled.values())[-2] <= 16 << 20
    assert len(filled) <= 1.06 * sum(sizes) / (16 << 20)


def test_a_group_above_the_mean_leaves_the_rest_even():
    sizes, counts = [5_000, 90, 40, 7], [1, 50, 60, 300]
    capacity = packing.smallest_capacity(sizes, counts, 8)
    filled = Counter()
    for i, number, fit in packing.best_fit(sizes, counts, capacity):
        filled[number] += fit * sizes[i]
    assert len(filled) == 8
    rest = [b for b in filled.values() if b < 5_000]
    assert len(rest) == 7 and max(rest) - min(rest) <= 90


def test_sharding_odd_input(spark):
    docs = odd_docs(spark)
    rows = packing.sharded(docs, 24).collect()
    assert len(rows) == docs.count()
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in odd_texts()}
    assert packing.sharded(no_docs(spark), 24).count() == 0


# --- 9 -------------------------------------------------------------------------------------


def brute_print(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=2):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= radius:
            parent[find(b)] = find(a)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("dense", [False, True])
def test_links_connect_all_within_radius(spark, dense):
    rng = random.Random(7)
    prints = set()
    for _ in range(25):
        seed = rng.getrandbits(64)
        for _ in range(60 if dense else 3):
            p = seed
            for bit in rng.sample(range(10 if dense else 64), rng.randint(0, 3)):
                p ^= 1 << bit
            prints.add(p)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    fps = spark.createDataFrame(signed, "fp long")
    for limit in (65, 0):  # with 0 all take the flips of the whole fingerprint
        links = simhash_dups.linked(fps, limit=limit)
        got = {r["node"]: r["root"] for r in components.components(links, "a", "b").collect()}
        want = brute_components(prints)
        sets = defaultdict(set)
        for p, root in want.items():
            sets[root].add(p - (1 << 64) if p >> 63 else p)
        for group in sets.values():
            assert {got.get(p, p) for p in group} == {min(group)}


def test_near_duplicates_of_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10_000 + (i or 900), t) for i, t in odd_texts()], "doc_id long, text string")
    docs = docs.unionByName(odd)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    roots = brute_components(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[roots[p]] = min(i, least.get(roots[p], i))
    rows = simhash_dups.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == least[roots[prints[r["doc_id"]]]]


def test_near_duplicates_odd_input(spark):
    rows = simhash_dups.near_duplicates(odd_docs(spark)).collect()
    assert len(rows) == len(odd_texts()) and {r["component_id"] for r in rows if r["doc_id"] in (4, 5, None)} == {4}
    assert simhash_dups.near_duplicates(no_docs(spark)).count() == 0


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(8)
    costs = rng.integers(0, 50, (3, 4, 40)).astype(float)
    picked, cost = simhash_dups.allocate(costs, 2)
    for row in range(40):
        options = [(a, b, c) for a in range(4) for b in range(4) for c in range(4) if a + b + c == 3]
        assert cost[row] == min(costs[0, a, row] + costs[1, b, row] + costs[2, c, row] for a, b, c in options)
        assert (picked[:, row] + 1).sum() == 3


# --- 10 ------------------------------------------------------------------------------------


def brute_passages(docs, length):
    holders = defaultdict(set)
    for doc, text in docs:
        words = (text or "").split(" ")
        for s in range(len(words) - length + 1):
            holders[tuple(words[s : s + length])].add(doc)
    out = set()
    for doc, text in dict(docs).items():
        words = (text or "").split(" ")
        starts = [s for s in range(len(words) - length + 1) if holders[tuple(words[s : s + length])] - {doc}]
        runs = []
        for s in starts:
            if runs and s <= runs[-1][-1] + length:
                runs[-1].append(s)
            else:
                runs.append([s])
        for run in runs:
            out.add((doc, run[0], run[-1] - run[0] + length))
    return out


@pytest.mark.parametrize(("length", "block"), [(50, 26), (20, 11), (6, 3)])
def test_passages_match_brute_force(spark, length, block):
    rng = random.Random(length)
    passages = [sentence(rng, n) for n in (length - 1, length, length + 1, 3 * length)]
    docs = [(i, " ".join([sentence(rng, rng.randint(0, 30)), *rng.sample(passages, rng.randint(0, 3)), sentence(rng, 9)]).strip()) for i in range(40)]
    docs += [(90, passages[3] + " " + passages[3]), (91, "x " * 300 + "x"), (92, "x " * 200 + "y"), (93, " ".join(passages[3].split()[: 2 * length]))]
    got = suffix_dups.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string"), length, block).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == brute_passages(docs, length)


def test_passages_odd_input(spark):
    got = suffix_dups.repeated_passages(odd_docs(spark)).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == {(4, 0, 130), (5, 0, 130), (6, 0, 130)}
    assert suffix_dups.repeated_passages(no_docs(spark)).count() == 0


def test_passages_of_documents_with_several_texts(spark):
    """A repeated doc_id whose one text is a copy keeps the passages of its other text."""
    rng = random.Random(14)
    shared, a = sentence(rng, 60), sentence(rng, 70)
    b, c = f"{sentence(rng, 11)} {shared} {sentence(rng, 30)}", f"{sentence(rng, 25)} {shared}"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b), (3, c)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["start_word"], r["n_words"]) for r in suffix_dups.repeated_passages(docs).collect())
    assert got == [(1, 0, 70), (2, 0, 70), (2, 11, 60), (3, 25, 60)]
    alone = spark.createDataFrame([(2, b), (2, c)], "doc_id long, text string")
    assert suffix_dups.repeated_passages(alone).count() == 0
