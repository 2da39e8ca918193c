"""Byte-level BPE of whole texts through one shuffle of their distinct words.

A task cuts its texts into pre-tokens, numbers the distinct ones of each block of texts and
writes their positions as numbers to a file in the shared folder. The distinct words go to
the task that their hash names, which encodes each of them once, wherever it occurred; the
ids go back to the blocks, whose positions say how they make up the texts.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.llm.coded_blocks import Numbering, packed, put_back, unpacked
from triploom.llm.pretokens import CHUNK_BYTES, Chunk, chunked, gathered, pieces
from triploom.llm.storage import open_folder, shared_folder, stored

BLOCK_BYTES = 16 << 20
MOST_BUCKETS = 4096
#: A task forgets the words of its bucket beyond so many; they'd only be encoded again.
KNOWN_WORDS = 1_000_000
CODED = "block long, part int, bucket int, words binary, doc_ids array<long>, counts array<int>, open boolean, path string, at long, size long"


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table by id: where the bytes of each token start, how many they are, and all bytes."""
    ranks = ranks_of(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    sizes = np.array([len(t) for t in table])
    return np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(table), np.uint8)


def pack_words(words: list[bytes]) -> bytes:
    sizes = packed(np.array([len(w) for w in words], np.int64))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(words), 3)


def unpack_words(content: bytes) -> list[bytes]:
    middle = 4 + int.from_bytes(content[:4], "little")
    ends = np.cumsum(unpacked(content[4:middle]).astype(np.int64)).tolist()
    joined = zstandard.decompress(content[middle:])
    return [joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


class _Block:
    """Texts of one block part, until they are enough."""

    def __init__(self) -> None:
        self.codes: list[pa.DictionaryArray] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, chunk: Chunk, docs: list[int | None]) -> None:
        found, at = pieces(chunk)
        self.codes.append(found.dictionary_encode())
        if chunk.part and self.docs:
            self.counts[-1] += len(found)
        else:
            self.docs += docs
            self.counts += np.diff(at).tolist()
        self.size += len(chunk.data)

    def coded(self) -> tuple[list[bytes], np.ndarray]:
        """The distinct words, frequent ones first, and the number of each word in order."""
        whole = pa.chunked_array(self.codes).unify_dictionaries()
        codes = np.concatenate([c.indices.to_numpy() for c in whole.chunks])
        words = whole.chunk(0).dictionary
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        return words.take(pa.array(order)).to_pylist(), rank[codes]


def _coder(folder: str, buckets: int, block_bytes: int, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.codes"
        number, held, block, part = Numbering(), _Block(), None, 0
        with files.open_output_stream(f"{path}/{name}") as out:

            def flushed(is_open: bool) -> pa.RecordBatch:
                words, codes = held.coded()
                bucket = np.array([xxhash.xxh32_intdigest(w) % buckets for w in words], np.int64)
                content = [packed(bucket), packed(codes)]
                row = {"block": block, "part": part, "bucket": -1, "doc_ids": held.docs, "counts": held.counts, "open": is_open, "path": name}
                row |= {"at": out.tell(), "size": len(content[0])}
                out.write(content[0])
                out.write(content[1])
                row["words"] = len(content[1]).to_bytes(8, "little")
                rows = [row]
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
                for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if y > x:
                        rows.append({"block": block, "part": part, "bucket": b, "words": pack_words([words[i] for i in order[x:y]])})
                return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

            for batch in batches:
                docs = batch.column("doc_id").to_pylist()
                for chunk in chunked(batch.column("text"), chunk_bytes):
                    if block is None:
                        block, part = number(), 0
                    held.add(chunk, docs[chunk.rows.start : chunk.rows.stop])
                    if held.size >= block_bytes:
                        yield flushed(not chunk.last)
                        block, part = (None, 0) if chunk.last else (block, part + 1)
                        held = _Block()
            if held.docs:
                yield flushed(False)

    return run


SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("part", pa.int32()), ("bucket", pa.int32()), ("words", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())), ("open", pa.bool_()), ("path", pa.string()), ("at", pa.int64()), ("size", pa.int64()),
    ]
)


def _word_encoder(ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known, current = _encoding(ranks).encode_ordinary, {}, None
        for batch in batches:
            out = []
            for bucket, content in zip(batch.column("code").to_pylist(), batch.column("words").to_pylist(), strict=True):
                if bucket != current or len(known) > KNOWN_WORDS:
                    known, current = {}, bucket
                words = unpack_words(content)
                for word in words:
                    if word not in known:
                        known[word] = np.array(encode(word.decode()), "<u4").tobytes()
                out.append(pack_words([known[w] for w in words]))
            kept = [c for c in batch.schema.names if c != "words"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.binary())], names=[*kept, "ids"])

    return run


def _new_fill(folder: str):
    def new():
        files, path = open_folder(folder)
        begun: list[bytes] = []

        def fill(block: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
            row = block.to_pylist()[0]
            with files.open_input_file(f"{path}/{row['path']}") as source:
                source.seek(row["at"])
                bucket = unpacked(source.read(row["size"]))
                codes = unpacked(source.read(int.from_bytes(row["words"], "little")))
            words = [w for content in answers.column("ids").to_pylist() for w in unpack_words(content)]
            if len(words) != len(bucket):
                raise ValueError("ids of some words are missing")
            order = np.argsort(bucket, kind="stable")
            taken = np.array([len(w) // 4 for w in words], np.int64)
            sizes, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
            sizes[order], starts[order] = taken, np.cumsum(taken) - taken
            ids, ends = gathered(codes, starts, sizes, np.frombuffer(b"".join(words), "<u4"))
            bounds = np.r_[0, ends][np.cumsum([0, *row["counts"]])].tolist()
            made = [ids[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            begun.append(made[0])
            if len(made) > 1 or not row["open"]:
                made[0] = b"".join(begun)
                begun.clear()
            if row["open"]:
                if len(made) > 1:
                    begun.append(made[-1])
                made = made[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"][: len(made)], pa.int64()), pa.array(made, pa.binary())], names=["doc_id", "ids"])

        return fill

    return new


def encoded(docs: DataFrame, ranks: str, block_bytes: int = BLOCK_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id`` and ``ids``, the packed little-endian unsigned 32-bit ids, of every row of ``docs``.

    Whole texts are encoded as tiktoken does without special tokens; NULL and empty texts
    have no ids. Rows with repeated or NULL doc_ids are all kept. Other columns aren't
    carried along. ``ranks`` is the path of the vocabulary on every worker.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = shared_folder(spark, "codes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    coded = stored(rows.mapInArrow(_coder(folder, min(4 * parts, MOST_BUCKETS), block_bytes, chunk_bytes), CODED), "coded")
    words = coded.filter("bucket >= 0").select("block", "part", F.col("bucket").alias("code"), "words")
    words = words.repartition(parts, "code").sortWithinPartitions("code")
    answers = words.mapInArrow(_word_encoder(ranks), "block long, part int, code int, ids binary")
    return put_back(coded.filter("bucket < 0").drop("bucket"), answers, _new_fill(folder), "doc_id long, ids binary")


def _decoder(ranks: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, sizes, content = token_bytes(ranks)
        for batch in batches:
            out = []
            for ids in batch.column("ids"):
                own = np.frombuffer(ids.as_buffer() or b"", "<u4") if ids.is_valid else np.zeros(0, np.uint32)
                out.append(gathered(own, starts, sizes, content)[0].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, column])

    return run


def decoded(ids: DataFrame, ranks: str, column: str = "decoded") -> DataFrame:
    """``ids`` with ``column``, the bytes of its packed ids: each id joined with the token-byte table.

    The table has a row per id of the vocabulary and is read from ``ranks`` in each task. An
    id that isn't in the vocabulary raises; NULL decodes to no bytes.
    """
    schema = ids.drop(column).schema.add(column, "binary")
    return ids.drop(column).mapInArrow(_decoder(ranks, column), schema)
