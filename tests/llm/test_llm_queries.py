"""The registered queries: SQL where there is some, and the pipeline's decisions."""

from __future__ import annotations

import hashlib
import random
import zlib
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from triploom.llm import decontaminate, quality, simhash_dups
from triploom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLES[name])
    columns = sorted(ours.columns)
    names = [c[0] for c in theirs.description]
    assert sorted(names) == columns
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in theirs.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in ours.collect()), key=repr) == expected


def test_all_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert queries().keys() >= {*QUERIES, "pipeline"}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, seen, SF_DIR)
        assert kept.columns == docs.columns
        before, after = seen.count(), kept.count()
        if name.startswith("quality"):
            good = quality.accepted(seen).count()
            assert after == good < before
        if name.startswith("SimHash"):
            assert after == kept.select("doc_id").distinct().count() < before
        if name.startswith("benchmark"):
            found = decontaminate.matches(seen, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
            assert after == before - found.select("doc_id").distinct().count() < before
        seen = kept
    rows = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in corpus_pipeline.STAGES[-1][1](spark, seen, SF_DIR).collect())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = [], 0
    for r in sorted(seen.collect(), key=lambda r: r["doc_id"]):
        ids = np.array([*library.encode(r["text"], add_special_tokens=False).ids, 0], "<u4")
        expected.append((start, r["doc_id"], len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows == expected
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == expected


@pytest.mark.parametrize("large", [0, 60])
def test_near_dedup_stage_keeps_one_of_each_brute_force_group(spark, large):
    rng = random.Random(12)
    texts = [None, "", " "]
    for _ in range(40):
        words = [f"w{rng.randrange(5_000)}" for _ in range(rng.randint(100, 400))]
        for edits in (0, 0, 1, 1, 2, 4, 30):
            copy = list(words)
            for at in rng.sample(range(len(copy)), edits):
                copy[at] = f"e{rng.randrange(5_000)}"
            texts.append(" ".join(copy))
    texts += [f"a common line that is in all of them . {i % 7}" for i in range(large)]
    ids = [rng.choice([None, *range(len(texts))]) if rng.random() < 0.3 else i for i in range(len(texts))]
    rows = [(i, t, rng.choice("ab")) for i, t in zip(ids, texts, strict=True)]
    rows += rows[::9]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    keys = sorted({(i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest()) for i, t, _ in rows})
    text_of = {(i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest()): t for i, t, _ in rows}
    fps = simhash_dups.fingerprints([(text_of[k] or "").encode() for k in keys], 3).tolist()
    root = list(range(len(keys)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(keys)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            one, other = sorted((top(i), top(j)))
            root[other] = one
    kept = [keys[i] for i in range(len(keys)) if top(i) == i]
    expected = []
    for k in kept:
        expected.append(min(s for i, t, s in rows if (i is None, i or 0, hashlib.md5((t or "").encode()).hexdigest()) == k))
    found = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    got = found.collect()
    assert len(got) == len(kept) < len(keys) - 30
    rows_kept = [(r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest(), r.source) for r in got]
    assert sorted(rows_kept) == [(*k, s) for k, s in zip(kept, expected, strict=True)]
