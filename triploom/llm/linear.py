"""A hashed linear classifier over whole texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 16
STEPS = 120
RATE = 1.0
TELLING = 4.0
DECAY = 1e-6
UPPER = bytes(range(65, 91))
SYMBOLS = b"&%#$*|"


def traits(text: bytes) -> dict[str, float]:
    """Shares that describe the form of a text; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return dict.fromkeys(("words", "distinct", "repeats", "symbols", "upper", "shouts", "bars", "stops", "length", "lines"), 0.0)
    letters = max(1, sum(map(len, words)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return {
        "words": n,
        "distinct": len(set(words)) / n,
        "repeats": sum(map(bytes.__eq__, words, words[1:])) / n,
        "symbols": (len(text) - len(text.translate(None, SYMBOLS))) / n,
        "upper": (len(text) - len(text.translate(None, UPPER))) / letters,
        "shouts": text.count(b"!!") / n,
        "bars": words.count(b"|") / n,
        "stops": (text.count(b". ") + text.count(b".\n") + text.rstrip().endswith(b".")) / n,
        "length": letters / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
    }


def features(text: bytes, form: bool = True) -> np.ndarray:
    """Slots of the text's distinct lower-cased words and, with ``form``, of its traits in steps."""
    words = {w.rstrip(b".,") for w in set(text.lower().split())}
    words.discard(b"")
    slots = {zlib.crc32(w) % SLOTS for w in words}
    if form:
        for name, value in traits(text).items():
            if name not in ("words", "length"):
                slots.add(zlib.crc32(f"{name} {int(8 * min(value, 1.0))}".encode()) % SLOTS)
    return np.fromiter(slots, np.int32, len(slots))


class Linear:
    """Softmax over sums of slot weights, the kept slots of a text scaled to length one."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, form: bool) -> None:
        self.weights, self.bias, self.form = weights, bias, form
        self.kept = np.ones(len(weights), bool)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.empty((len(texts), len(self.bias)))
        for i, text in enumerate(texts):
            at = features(text or b"", self.form)
            at = at[self.kept[at]]
            out[i] = self.bias + self.weights[at].sum(axis=0, dtype=np.float64) / np.sqrt(max(1, len(at)))
        return out

    def posteriors(self, texts: list[bytes | None]) -> np.ndarray:
        return softmax(self.scores(texts))


def softmax(scores: np.ndarray) -> np.ndarray:
    grown = np.exp(scores - scores.max(axis=1, keepdims=True))
    return grown / grown.sum(axis=1, keepdims=True)


def telling(at: np.ndarray, owner: np.ndarray, targets: np.ndarray, least: float = TELLING) -> np.ndarray:
    """The slots that some class has more or less often than chance would, by ``least`` deviations.

    Most slots belong to words too rare to tell anything; fitting them only learns the
    sample by heart.
    """
    share = np.bincount(at, minlength=SLOTS) / len(targets)
    most = np.zeros(SLOTS)
    for c in range(targets.shape[1]):
        weight = targets[:, c].sum()
        inside = np.bincount(at, targets[owner, c], SLOTS)
        most = np.maximum(most, np.abs(inside - weight * share) / np.sqrt(weight * share * (1 - share) + 1))
    return most > least


def fit(rows: list[np.ndarray], targets: np.ndarray, form: bool, steps: int = STEPS) -> Linear:
    """Fit to soft ``targets`` (rows x classes) by Adagrad on the telling slots of the sample."""
    classes = targets.shape[1]
    weights, bias = np.zeros((SLOTS, classes), np.float32), np.zeros(classes)
    if not len(rows):
        return Linear(weights, bias, form)
    kept = telling(np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), targets)
    rows = [r[kept[r]] for r in rows]
    sizes = np.array([len(r) for r in rows])
    at = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), sizes)
    scale = 1 / np.sqrt(np.maximum(1, sizes))
    seen, seen_bias = np.full((SLOTS, classes), 1e-8), np.full(classes, 1e-8)
    bias[:] = np.log(np.clip(targets.mean(axis=0), 1e-3, 1))
    for _ in range(steps):
        sums = np.stack([np.bincount(owner, weights[at, c], len(rows)) for c in range(classes)], axis=1)
        error = (softmax(sums * scale[:, None] + bias) - targets) / len(rows)
        spread = error * scale[:, None]
        gradient = np.stack([np.bincount(at, spread[owner, c], SLOTS) for c in range(classes)], axis=1) + DECAY * weights
        seen += gradient**2
        weights -= (RATE * gradient / np.sqrt(seen)).astype(np.float32)
        seen_bias += error.sum(axis=0) ** 2
        bias -= 0.1 * RATE * error.sum(axis=0) / np.sqrt(seen_bias)
    model = Linear(weights, bias, form)
    model.kept = kept
    return model


def _featuriser(form: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "_bytes"]
            found = [features(x or b"", form) for x in batch.column("_bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.list_(pa.int32()))], names=[*kept, "slots"])

    return run


def sample_features(docs: DataFrame, sample: DataFrame, form: bool) -> pa.Table:
    """The columns of ``sample`` (doc_id first) with ``slots``, for a sample of bounded size.

    The sample is broadcast, so only its texts are shuffled. Of rows that share a doc_id the
    text with the smallest digest counts.
    """
    once = docs.select("doc_id", F.col("text").cast("binary").alias("_bytes"))
    rows = once.join(F.broadcast(sample), "doc_id").select(*sample.columns, "_bytes")
    rows = rows.groupBy(*sample.columns).agg(F.min_by("_bytes", F.md5("_bytes")).alias("_bytes"))
    schema = f"{', '.join(f'`{n}` {t}' for n, t in sample.dtypes)}, slots array<int>"
    return rows.mapInArrow(_featuriser(form), schema).toArrow()
