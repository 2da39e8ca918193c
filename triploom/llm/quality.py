"""Quality by weak labels.

Heuristic labellers vote good, bad or nothing on every document. Expectation-maximisation
over the counts of all vote patterns estimates the shares of good documents and of each
fault; how often a labeller is right about its own fault and about good documents is
preset. The posteriors of a bounded sample then train a hashed linear scorer,
which scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.llm.linear import Linear, fit, sample_features, traits
from triploom.llm.storage import stored

SAMPLE_ROWS = 8_000
ROUNDS = 100
RARELY, MOSTLY = 0.002, 0.95
BAD, NONE, GOOD = 0, 1, 2

#: name, trait, bad from, good up to, words needed; between the limits there is no vote.
RISING = (
    ("symbols", "symbols", 0.3, 0.05, 1),
    ("capitals", "upper", 0.35, 0.15, 1),
    ("shouts", "shouts", 0.2, 0.0, 1),
    ("bars", "bars", 0.15, 0.0, 1),
    ("repeats", "repeats", 0.2, 0.03, 8),
    ("lines", "lines", 0.4, 0.0, 30),
)
#: name, trait, bad up to, good from, words needed.
FALLING = (("distinct", "distinct", 0.3, 0.45, 20), ("stops", "stops", 0.0, 0.04, 30))
LABELLERS = (*(r[0] for r in RISING), *(r[0] for r in FALLING), "length", "words")


def votes(text: bytes) -> list[int]:
    """The vote of each of ``LABELLERS``; a text without words gets one bad vote."""
    found = traits(text)
    out = []
    for _, trait, bad, good, least in RISING:
        value = found[trait]
        out.append(NONE if found["words"] < least else BAD if value >= bad else GOOD if value <= good else NONE)
    for _, trait, bad, good, least in FALLING:
        value = found[trait]
        out.append(NONE if found["words"] < least else BAD if value <= bad else GOOD if value >= good else NONE)
    out.append(NONE if found["words"] < 5 else GOOD if 2.5 <= found["length"] <= 12 else BAD)
    out.append(GOOD if found["words"] else BAD)
    return out


def _voter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            patterns = [sum(v * 3**i for i, v in enumerate(votes(x or b""))) for x in part.column("_bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(patterns, pa.int32())], names=["doc_id", "pattern"])


def with_votes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``pattern``, the votes as digits of base 3."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_bytes"))
    return rows.mapInArrow(_voter, T.StructType([rows.schema["doc_id"], T.StructField("pattern", T.IntegerType())]))


def digits(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3**i % 3 for i in range(len(LABELLERS))], axis=1)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Posteriors of good per pattern, accuracies ``[labeller, bad/good]`` and the prior of good.

    Faults exclude each other more than they come together, so a single class of bad
    documents would drift to the most frequent fault. There is one hidden class of good
    documents and one per labeller, of documents with the fault that it looks for. EM
    estimates the shares of the classes and how often each labeller calls documents with
    another's fault bad when it votes; no vote says nothing. That labellers rarely do so for
    good documents (``RARELY``) and mostly do for their own fault (``MOSTLY``) is as good as
    preset: a prior that weighs as much as all documents. Stops when no posterior moves by more than 1e-9.
    """
    found = digits(patterns)
    votes_good, votes_bad = (found == GOOD).astype(float), (found == BAD).astype(float)
    n, labellers = counts.sum(), found.shape[1]
    calls = np.full((labellers, labellers + 1), 0.1)
    calls[:, 0] = RARELY
    calls[np.arange(labellers), np.arange(1, labellers + 1)] = MOSTLY
    believed, weight = calls.copy(), np.full_like(calls, 2.0)
    weight[:, 0] = weight[np.arange(labellers), np.arange(1, labellers + 1)] = n + 1
    shares = np.r_[0.85, np.full(labellers, 0.15 / labellers)]
    posterior, members = np.zeros(len(patterns)), np.zeros((len(patterns), labellers + 1))
    for _ in range(rounds):
        members = np.log(shares) + votes_bad @ np.log(calls) + votes_good @ np.log(1 - calls)
        members = np.exp(members - members.max(axis=1, keepdims=True))
        members /= members.sum(axis=1, keepdims=True)
        before, posterior = posterior, members[:, 0]
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
        held = members * counts[:, None]
        shares = (held.sum(axis=0) + 1e-3) / (n + 1e-3 * len(shares))
        calls = (votes_bad.T @ held + believed * weight) / ((votes_bad + votes_good).T @ held + weight)
    bad = (members[:, 1:] * counts[:, None]).sum(axis=1)
    spotted = (votes_bad.T @ bad + 1) / ((votes_bad + votes_good).T @ bad + 2)
    return posterior, np.stack([spotted, 1 - calls[:, 0]], axis=1), float(shares[0])


def fit_quality(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Linear, DataFrame]:
    """The scorer, and ``doc_id``, ``pattern``, ``weak_label`` of all documents.

    The patterns of all documents are counted; there are at most 3 to the number of
    labellers, whatever the input. ``sample_rows`` documents, those with the smallest hash
    of their doc_id, train the scorer.
    """
    voted = stored(docs.transform(with_votes), "votes")
    counted = voted.groupBy("pattern").count().orderBy("pattern").toArrow()
    patterns, counts = counted.column("pattern").to_numpy(), counted.column("count").to_numpy()
    posterior, _, _ = expectation_maximisation(patterns, counts)
    spark = docs.sparkSession
    labels = spark.createDataFrame(list(zip(patterns.tolist(), posterior.tolist(), strict=True)), "pattern int, weak_label double")
    labelled = voted.join(F.broadcast(labels), "pattern").select("doc_id", "pattern", "weak_label")
    sample = labelled.filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "pattern").limit(sample_rows)
    sample = stored(sample.dropDuplicates(["doc_id"]).select("doc_id", "weak_label"), "sample")
    rows = sample_features(docs, sample, form=True)
    good = rows.column("weak_label").to_numpy()
    slots = [x.values.to_numpy() for x in rows.column("slots")]
    return fit(slots, np.stack([1 - good, good], axis=1), form=True), labelled


def _scorer(model: Linear):
    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        found = model.posteriors(texts.tolist())[:, 1]
        found[[not (t or b"").strip() for t in texts]] = 0.0
        return pd.Series(found)

    return score


def with_quality(docs: DataFrame, model: Linear) -> DataFrame:
    """All columns of ``docs`` with ``quality_score``, the scorer's probability of good.

    Texts without words, empty and NULL ones too, score 0. From a sample too small to tell
    good from bad, all others score its share of good ones. Rows are kept as they are;
    a column of the input named ``quality_score`` is replaced.
    """
    return docs.withColumn("quality_score", _scorer(model)(F.col("text").cast("binary")))


def accepted(docs: DataFrame, least: float = 0.5, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that the scorer accepts, columns unchanged."""
    model, _ = fit_quality(docs, sample_rows)
    return with_quality(docs, model).filter(F.col("quality_score") >= least).select(*docs.columns)
