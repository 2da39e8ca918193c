from triploom.operators.chains import (
    assemble_graph,
    longest_chains,
    trip_vertices,
    with_trip_id,
)
from triploom.operators.cycles import cycles, trip_cycles
from triploom.operators.features import (
    assemble_features,
    enrich,
    prepare,
    scale_features,
)
from triploom.operators.iforest import ForestModel, fit_isolation_forest
from triploom.operators.pairs import neighbour_totals, pair_totals
from triploom.operators.paths import chain_paths, chain_text
from triploom.operators.profile import (
    count_by,
    count_rows,
    positive_average,
    rows_with_nulls,
    summarize,
    totals,
)
from triploom.operators.quantile import (
    drop_outliers,
    exact_quantile,
    label_above,
    label_by_contamination,
    outlier_threshold,
    outliers,
)
from triploom.operators.ranking import (
    numbered,
    ranked,
    top_k,
    top_locations,
    top_paths,
    with_location,
)
from triploom.operators.successors import successor_edges
from triploom.operators.timeline import trip_chains

__all__ = [
    "ForestModel",
    "assemble_features",
    "assemble_graph",
    "chain_paths",
    "chain_text",
    "count_by",
    "count_rows",
    "cycles",
    "drop_outliers",
    "enrich",
    "exact_quantile",
    "fit_isolation_forest",
    "label_above",
    "label_by_contamination",
    "longest_chains",
    "neighbour_totals",
    "outlier_threshold",
    "outliers",
    "pair_totals",
    "positive_average",
    "prepare",
    "numbered",
    "ranked",
    "rows_with_nulls",
    "scale_features",
    "successor_edges",
    "summarize",
    "top_k",
    "top_locations",
    "top_paths",
    "totals",
    "trip_chains",
    "trip_cycles",
    "trip_vertices",
    "with_location",
    "with_trip_id",
]
