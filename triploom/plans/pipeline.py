"""The staged outlier pipeline: prepare, train, predict, clean, rank."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from triploom.operators import (
    ForestModel,
    drop_outliers,
    fit_isolation_forest,
    neighbour_totals,
    outliers,
    pair_totals,
    prepare,
    ranked,
    with_trip_id,
)
from triploom.operators.features import feature_columns
from triploom.operators.pairs import STRUCT_KEY
from triploom.schema import TRIP_COLUMNS
from triploom.sources import digest_of, is_current, read_stage, read_trips, stage_digest, write_stage

ALL_STAGES = ("prepare", "train", "predict", "clean", "top_pairs", "top_neighbours")


@dataclass(frozen=True)
class PipelineParams:
    """What to read, where to keep the stages' outputs, and how to run them."""

    trips_path: str
    base_dir: str
    trips_format: str = "csv"
    infer_schema: bool = False
    id_col: str | None = None
    features: str | tuple[str, ...] = "speed"
    num_trees: int = 100
    max_samples: int = 256
    contamination: float = 0.001
    seed: int = 1
    key: str = "columns"
    depth: int = 1

    @property
    def feature_names(self) -> tuple[str, ...]:
        return tuple(feature_columns(self.features))

    @property
    def _prepared(self) -> str:
        """Names the input and the features, so that no stage reads another run's files."""
        source = [self.trips_path, self.trips_format, self.infer_schema, self.id_col]
        digest = hashlib.sha256(repr(source).encode()).hexdigest()[:8]
        return "-".join([*self.feature_names, digest])

    @property
    def enriched_path(self) -> str:
        return f"{self.base_dir}/enriched_{self._prepared}.parquet"

    @property
    def model_path(self) -> str:
        return f"{self.base_dir}/iforest_{self._suffix}.model"

    @property
    def predicted_path(self) -> str:
        return f"{self.base_dir}/predicted_{self._suffix}.parquet"

    @property
    def cleaned_path(self) -> str:
        return f"{self.base_dir}/cleaned_{self._suffix}.parquet"

    @property
    def _suffix(self) -> str:
        trained = f"t{self.num_trees}_m{self.max_samples}_s{self.seed}_c{self.contamination}"
        return f"{self._prepared}_{trained}"


def run_pipeline(
    spark: SparkSession,
    params: PipelineParams,
    stages: Sequence[str] = ALL_STAGES,
    resume: bool = True,
) -> dict[str, DataFrame]:
    """Run the chosen stages in order; returns each one's result table.

    A stage reads the files of the stage before it, so any stage can run alone once its
    predecessor has. Outputs are replaced as a whole, and with ``resume`` a stage whose
    newest output was made from the same input and parameters is not run again: a rerun
    after a failure goes on where the last whole stage ended. ``predict`` gives the
    outliers, the two ``top`` stages the ranked pairs; ``train`` only saves its model.
    """
    if unknown := set(stages) - set(ALL_STAGES):
        raise ValueError(f"unknown stages {sorted(unknown)}; choose from {ALL_STAGES}")
    results: dict[str, DataFrame] = {}

    def due(stage: str, path: str, *sources: str) -> str | None:
        """The digest of what the stage is made from, or None if it need not run."""
        if stage not in stages:
            return None
        digest = digest_of(stage, asdict(params), *(stage_digest(spark, s) for s in sources))
        return None if resume and is_current(spark, path, digest) else digest

    if digest := due("prepare", params.enriched_path, params.trips_path):
        trips = read_trips(
            spark, params.trips_path, params.trips_format, params.infer_schema
        )
        trips = with_trip_id(trips, params.id_col)
        write_stage(prepare(trips, params.features), params.enriched_path, digest)
    if "prepare" in stages:
        results["prepare"] = read_stage(spark, params.enriched_path)
    if digest := due("train", params.model_path, params.enriched_path):
        model = fit_isolation_forest(
            read_stage(spark, params.enriched_path),
            id_col=TRIP_COLUMNS.trip_id,
            num_trees=params.num_trees,
            max_samples=params.max_samples,
            contamination=params.contamination,
            seed=params.seed,
        )
        model.save(spark, params.model_path, digest)
    if digest := due("predict", params.predicted_path, params.enriched_path, params.model_path):
        model = ForestModel.load(spark, params.model_path)
        enriched = read_stage(spark, params.enriched_path)
        write_stage(model.transform(enriched), params.predicted_path, digest)
    if "predict" in stages:
        results["predict"] = outliers(read_stage(spark, params.predicted_path))
    if digest := due("clean", params.cleaned_path, params.predicted_path):
        predicted = read_stage(spark, params.predicted_path)
        write_stage(drop_outliers(predicted), params.cleaned_path, digest)
    if "clean" in stages:
        results["clean"] = read_stage(spark, params.cleaned_path)
    if "top_pairs" in stages:
        cleaned = read_stage(spark, params.cleaned_path)
        sums = pair_totals(cleaned, key=params.key)
        ties = [f"`{STRUCT_KEY}`"] if params.key == "struct" else TRIP_COLUMNS.pair
        results["top_pairs"] = ranked(sums, "total_amount", ties)
    if "top_neighbours" in stages:
        cleaned = read_stage(spark, params.cleaned_path)
        sums = neighbour_totals(cleaned, params.depth)
        results["top_neighbours"] = ranked(
            sums, "cumulated_total_amount", TRIP_COLUMNS.pair
        )
    return results
