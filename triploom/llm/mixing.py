"""Mixing by soft membership of documents in domains.

A classifier fitted to a labelled table gives each document a posterior over the domains.
The expected tokens of a domain are then a linear function of the documents' rates. Those
whose totals match the targets in the least-squares sense are found by Newton steps in the
domains, projected on the nonnegative rates; plain projected gradient steps in the rates
need hundreds of passes where a domain is scarce, and thousands where a target is out of reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triploom.llm.linear import Linear, fit, sample_features
from triploom.llm.storage import stored

SAMPLE_ROWS = 16_000
STEPS = 60
CLOSE = 1e-7
#: What a rate's distance from 1 weighs beside the squared error of the totals.
STAY = 1e-8


def fit_domains(docs: DataFrame, labels: DataFrame, domain: str, sample_rows: int = SAMPLE_ROWS) -> tuple[Linear, list[str]]:
    """A classifier of the values of ``domain``, an SQL expression over ``labels``.

    It is fitted to ``sample_rows`` labelled documents at most, those with the smallest
    hash of their doc_id. Rows without doc_id or domain are not used; of several labels of
    a document the smallest is. Without labels all documents are in one domain, ``all``.
    """
    known = labels.select("doc_id", F.expr(domain).cast("string").alias("domain")).dropna().groupBy("doc_id").agg(F.min("domain").alias("domain"))
    sample = stored(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "labelled")
    rows = sample_features(docs, sample, form=True)
    found = np.array(rows.column("domain").to_pylist(), dtype=object)
    names = sorted(set(found)) or ["all"]
    targets = np.stack([found == n for n in names], axis=1).astype(float)
    return fit([x.values.to_numpy() for x in rows.column("slots")], targets, form=True), names


def _classifier(model: Linear):
    @F.pandas_udf("tokens double, posteriors array<double>")
    def classify(texts: pd.Series) -> pd.DataFrame:
        found = list(model.posteriors(texts.tolist()))
        return pd.DataFrame({"tokens": [float(len((t or b"").split())) for t in texts], "posteriors": found})

    return classify


def with_posteriors(docs: DataFrame, model: Linear) -> DataFrame:
    """``docs`` with ``tokens`` (words) and ``posteriors``; a NULL text has no words."""
    docs = docs.drop("tokens", "posteriors")
    found = docs.withColumn("_found", _classifier(model)(F.col("text").cast("binary")))
    return found.select(*docs.columns, "_found.tokens", "_found.posteriors")


def rates_of(posteriors: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """The rates after ``steps``: from 1, each moves against the sum of its gradients, down to 0 at most."""
    return np.maximum(0, 1 - posteriors @ np.sum(steps, axis=0)) if steps else np.ones(len(posteriors))


def _posteriors(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("posteriors").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _totals(steps: list[np.ndarray]):
    """Sums of rate x tokens x posterior; of tokens x posterior x posterior where the rate isn't 0; of tokens x rate x rate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                p, tokens = _posteriors(batch), batch.column("tokens").to_numpy()
                rates = rates_of(p, steps)
                free = p[rates > 0]
                total = total + np.r_[(rates * tokens) @ p, ((free * tokens[rates > 0][:, None]).T @ free).ravel(), tokens @ rates**2]
        flat = np.ravel(total) if np.ndim(total) else np.zeros(0)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(flat))), "total": pa.array(flat)})

    return run


def _summed(members: DataFrame, steps: list[np.ndarray], domains: int) -> tuple[np.ndarray, np.ndarray, float]:
    out = np.zeros(domains + domains**2 + 1)
    for row in members.mapInArrow(_totals(steps), "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total")).collect():
        out[row["cell"]] = row["total"]
    return out[:domains], out[domains:-1].reshape(domains, domains), float(out[-1])


def fit_rates(members: DataFrame, targets: np.ndarray, most: int = STEPS) -> list[np.ndarray]:
    """The gradient steps that lead to rates whose expected totals meet ``targets``.

    Minimises the squared error of the totals, as shares of all targets, plus ``STAY`` times
    the squared distance of the rates from 1. So targets that nonnegative rates can meet are
    met by the rates nearest to 1, and others are missed by as little as can be. The rates
    depend on a number per domain only, in which Newton steps, shortened until the convex
    dual falls, settle the error. Each step is one pass over ``tokens`` and ``posteriors``
    that sums a number per domain and pair of domains; the steps are all that the tasks
    need to know to work out any document's rate. Stops at a gradient within ``CLOSE``.
    """
    whole = max(float(targets.sum()), 1e-9)
    goal, ridge = targets / whole, STAY * np.eye(len(targets))

    def state(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, float]:
        at = np.sum(steps, axis=0) if steps else np.zeros(len(targets))
        totals, moments, squares = _summed(members, steps, len(targets))
        return totals / whole - goal - STAY * at, moments / whole + ridge, squares / whole / 2 + goal @ at + STAY / 2 * at @ at

    steps: list[np.ndarray] = []
    error, moments, height = state(steps)
    passes = 1
    while passes < most and np.abs(error).max(initial=0) > CLOSE:
        step = np.linalg.solve(moments, error)
        slope = error @ step
        while True:
            after = state([*steps, step])
            passes += 1
            if after[2] <= height - 1e-4 * (error @ step):
                break
            if passes >= most or error @ step < 1e-9 * slope:
                return steps
            turned = after[0] @ step
            scale = error @ step / (error @ step - turned) if turned < 0 else 0.5
            step = step * min(0.8, max(0.05, scale))
        steps.append(step)
        error, moments, height = after
    return steps


def _rater(steps: list[np.ndarray]):
    @F.pandas_udf(T.DoubleType())
    def rate(posteriors: pd.Series) -> pd.Series:
        return pd.Series(rates_of(np.stack(posteriors.to_numpy()), steps) if len(posteriors) else [])

    return rate


def targets_of(present: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Tokens wanted per domain: all present ones by weight, but none in a domain without expected tokens."""
    wanted = np.where(present > 0, weights, 0.0)
    return present.sum() * wanted / wanted.sum() if wanted.sum() else present.copy()


def with_rates(docs: DataFrame, labels: DataFrame, domain: str, weights: dict[str, float], sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``tokens``, ``posteriors``, ``rate`` and ``copies``.

    ``weights`` are relative; a domain that it doesn't name gets 0. The whole budget is the
    present number of tokens. A rate has no upper bound: a domain with few tokens may take
    many copies to reach its weight. ``copies``
    rounds the rate up or down with a chance given by its fraction and drawn from the hash
    of the doc_id, so the same input gives the same mix. NULL and empty texts weigh nothing
    but have a rate. Columns of the input with these names are replaced.
    """
    model, names = fit_domains(docs, labels, domain, sample_rows)
    members = stored(with_posteriors(docs.drop("rate", "copies"), model), "posteriors")
    lean = members.select("tokens", "posteriors")
    present, _, _ = _summed(lean, [], len(names))
    steps = fit_rates(lean, targets_of(present, np.array([weights.get(n, 0.0) for n in names])))
    rated = members.withColumn("rate", _rater(steps)("posteriors"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    return rated.withColumn("copies", F.floor(F.col("rate") + draw).cast("int"))


def mixed(docs: DataFrame, labels: DataFrame, domain: str, weights: dict[str, float]) -> DataFrame:
    """Each row of ``docs`` as many times as its rate asks for, columns unchanged."""
    rated = with_rates(docs, labels, domain, weights).filter("copies > 0")
    return rated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)
