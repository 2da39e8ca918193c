"""The registered queries again, as plain SQL over the same tables."""

from __future__ import annotations

from triploom.plans.views import (
    EVENT_MAX_IDLE_S,
    EVENT_TRIPS_SQL,
    LOCATIONS_SQL,
    ORDER_TRIP_COLUMNS,
    ORDER_TRIPS_SQL,
)
from triploom.schema import NULL_CHECK_COLUMNS, SUMMARY_COLUMNS

WITH_TRIPS = f"WITH trips AS ({ORDER_TRIPS_SQL})"
WITH_LOCATIONS = f"{WITH_TRIPS}, locations AS ({LOCATIONS_SQL})"
PAIR = "PULocationID, DOLocationID"
EXACT_AMOUNT = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"

DURATION = (
    "date_diff('second', date_trunc('second', tpep_pickup_datetime), "
    "date_trunc('second', tpep_dropoff_datetime))"
)
ENRICHED = f"{PAIR}, passenger_count, trip_distance, total_amount, trip_duration"
WITH_ENRICHED = (
    f"{WITH_TRIPS}, timed AS (SELECT *, {DURATION} AS trip_duration FROM trips), "
    "enriched AS (SELECT *, trip_distance / trip_duration AS speed FROM timed "
    "WHERE trip_distance IS NOT NULL AND trip_duration > 0)"
)
WITH_LABELS = (
    f"{WITH_ENRICHED}, labelled AS (SELECT {ENRICHED}, speed, "
    "CASE WHEN speed >= (SELECT quantile_disc(speed, 0.999) FROM enriched) "
    "THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predictedLabel FROM enriched)"
)
WITH_PAIRS = f"{WITH_TRIPS}, pairs AS (SELECT {PAIR}, count(*) AS count FROM trips GROUP BY ALL)"
WITH_TOTALS = (
    f"{WITH_TRIPS}, totals AS "
    f"(SELECT {PAIR}, {EXACT_AMOUNT} AS total_amount FROM trips GROUP BY {PAIR})"
)


def _summary(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM {table}"
        for c in columns
    )


def _top_locations(key: str) -> str:
    return (
        f"{WITH_LOCATIONS}, top AS (SELECT {key}, count(*) AS count FROM trips "
        f"GROUP BY {key} ORDER BY count DESC, {key} LIMIT 10) "
        f"SELECT {key}, count, Zone, Borough FROM top "
        f"LEFT JOIN locations ON {key} = LocationID"
    )


def _named_pairs(pairs: str) -> str:
    return (
        f"SELECT {PAIR}, count, p.Zone AS PU_Zone, p.Borough AS PU_Borough, "
        f"d.Zone AS DO_Zone, d.Borough AS DO_Borough FROM {pairs} "
        "LEFT JOIN locations p ON PULocationID = p.LocationID "
        "LEFT JOIN locations d ON DOLocationID = d.LocationID"
    )


def _neighbours(depth: int) -> str:
    return (
        f"{WITH_TOTALS} SELECT a.PULocationID, a.DOLocationID, "
        "round(a.total_amount + coalesce(CAST(sum(CAST(b.total_amount AS DECIMAL(18,2))) "
        "AS DOUBLE), 0), 2) AS cumulated_total_amount FROM totals a LEFT JOIN totals b "
        f"ON abs(a.PULocationID - b.PULocationID) <= {depth} "
        f"AND abs(a.DOLocationID - b.DOLocationID) <= {depth} "
        "AND NOT (a.PULocationID = b.PULocationID AND a.DOLocationID = b.DOLocationID) "
        "GROUP BY a.PULocationID, a.DOLocationID, a.total_amount"
    )


EDGES = (
    f"trips AS ({EVENT_TRIPS_SQL}), edges AS (SELECT a.tripId AS src, b.tripId AS dst "
    "FROM trips a JOIN trips b ON a.DOLocationID = b.PULocationID "
    "AND a.tpep_dropoff_datetime < b.tpep_pickup_datetime "
    "AND date_diff('second', date_trunc('second', a.tpep_dropoff_datetime), "
    f"date_trunc('second', b.tpep_pickup_datetime)) < {EVENT_MAX_IDLE_S} "
    "AND coalesce(a.tpep_dropoff_datetime >= a.tpep_pickup_datetime, true) "
    "AND coalesce(b.tpep_dropoff_datetime >= b.tpep_pickup_datetime, true))"
)


def _chains(weight: str, edges: str = EDGES, extra: str = "0.0::DOUBLE") -> str:
    return (
        f"WITH RECURSIVE {edges}, weighted AS (SELECT tripId, {weight} AS w FROM trips), "
        "paths(id, total) AS (SELECT tripId, w FROM weighted UNION ALL "
        f"SELECT e.dst, t.w + (p.total + {extra}) FROM paths p JOIN edges e ON p.id = e.src "
        "JOIN weighted t ON t.tripId = e.dst), "
        "best AS (SELECT id, max(total) AS total FROM paths GROUP BY id), "
        f"offers AS (SELECT e.dst, e.src, b.total + {extra} AS total FROM edges e JOIN best b ON b.id = e.src), "
        "tops AS (SELECT dst, max(total) AS top FROM offers GROUP BY dst), "
        "fathers AS (SELECT o.dst, min(o.src) AS father FROM offers o JOIN tops t "
        "ON o.dst = t.dst AND o.total = t.top WHERE t.top > 0 GROUP BY o.dst), "
        "chains AS (SELECT id AS tripID, total AS longestDistance, "
        "coalesce(father, id) AS previousTripID FROM best LEFT JOIN fathers ON id = dst)"
    )


ALL_CHAINS = "SELECT * FROM chains"
WAITED = (
    "-floor(date_diff('second', date_trunc('second', a.tpep_dropoff_datetime), "
    "date_trunc('second', b.tpep_pickup_datetime)) / 7200.0::DOUBLE)"
)

TREES, SAMPLE, LEVELS, SEED, POOL, PRIME = 100, 256, 8, 1, 4 * 100 * 256, (1 << 31) - 1


def _uniform(*parts: object) -> str:
    joined = ", ".join(f"'{p}'" if isinstance(p, str) and p in ("feature", "split", "hash") else str(p) for p in parts)
    return f"(('0x' || substr(md5(concat_ws(':', {joined})), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE)"


def _path(size: str) -> str:
    return (
        f"(CASE WHEN {size} > 2 THEN 2 * (ln({size} - 1) + 0.5772156649015329::DOUBLE) - 2.0::DOUBLE * ({size} - 1) / {size} "
        f"WHEN {size} = 2 THEN 1 ELSE 0 END)"
    )


def _forest(columns: tuple[str, ...]) -> str:
    """The forest over event trips grown level by level, and the score of every trip."""
    xs = [f"x{i}" for i in range(len(columns))]
    low, high, value = (
        f"(CASE feature {' '.join(f'WHEN {i} THEN {kind}{x}' for i, x in enumerate(xs))} END)"
        for kind in ("lo", "hi", "")
    )
    scaled = ", ".join(
        f"{c} / (SELECT stddev_samp({c}) FROM enriched) AS x{i}" for i, c in enumerate(columns)
    )
    wide = ", ".join(f"CASE WHEN lo{x} < hi{x} THEN {i} END" for i, x in enumerate(xs))
    ranges = ", ".join(f"min({x}) AS lo{x}, max({x}) AS hi{x}" for x in xs)
    all_x = ", ".join(xs)
    child = f"CASE WHEN feature >= 0 THEN 2 * node + ({value} >= split)::INTEGER ELSE node END AS node"
    draw = _uniform(SEED, "tree", "node", "split")
    sql = (
        f"WITH trips AS ({EVENT_TRIPS_SQL}), timed AS (SELECT *, {DURATION} AS trip_duration FROM trips), "
        "enriched AS (SELECT *, trip_distance / trip_duration AS speed FROM timed "
        "WHERE trip_distance IS NOT NULL AND trip_duration > 0), "
        f"points AS MATERIALIZED (SELECT tripId, {PAIR}, trip_distance, trip_duration, speed, {scaled} FROM enriched), "
        "sizes AS (SELECT count(*) AS n FROM points), "
        f"factors AS (SELECT tree, md5(concat_ws(':', {SEED}, tree, 'draw')) AS d FROM (SELECT unnest(range({TREES})) AS tree)), "
        f"drawn AS (SELECT tree, {all_x}, tripId, ((('0x' || substr(d, 1, 8))::BIGINT % {PRIME - 1} + 1) "
        f"* floor({_uniform(SEED, 'tripId', 'hash')} * {PRIME})::BIGINT + ('0x' || substr(d, 9, 8))::BIGINT % {PRIME}) % {PRIME} AS draw "
        "FROM points, sizes, factors "
        f"WHERE {_uniform(SEED, 'tripId')} < least(1.0::DOUBLE, {POOL}::DOUBLE / n)), "
        f"level0 AS MATERIALIZED (SELECT tree, {all_x}, 1 AS node FROM drawn, sizes "
        f"WHERE draw < least(1.0::DOUBLE, {2 * SAMPLE + 64}::DOUBLE / least(n, {POOL})) * {PRIME} "
        f"QUALIFY row_number() OVER (PARTITION BY tree ORDER BY draw, tripId) <= {SAMPLE}), "
        "walk0 AS (SELECT *, 1 AS node FROM points, (SELECT unnest(range(100)) AS tree))"
    )
    for d in range(LEVELS + 1):
        usable = f"list_filter([{wide}], lambda v: v IS NOT NULL)" if d < LEVELS else "[]::INTEGER[]"
        sql += (
            f", range{d} AS (SELECT tree, node, count(*) AS size, {ranges} FROM level{d} GROUP BY tree, node), "
            f"usable{d} AS (SELECT *, {usable} AS usable FROM range{d}), "
            f"chosen{d} AS (SELECT *, CASE WHEN len(usable) > 0 THEN usable[1 + floor("
            f"{_uniform(SEED, 'tree', 'node', 'feature')} * len(usable))::INTEGER] ELSE -1 END AS feature FROM usable{d}), "
            f"nodes{d} AS MATERIALIZED (SELECT tree, node, size, feature, CASE WHEN feature < 0 THEN 0.0::DOUBLE "
            f"WHEN {low} + {draw} * ({high} - {low}) > {low} THEN {low} + {draw} * ({high} - {low}) "
            f"ELSE {high} END AS split FROM chosen{d})"
        )
        if d < LEVELS:
            sql += (
                f", level{d + 1} AS MATERIALIZED (SELECT tree, {all_x}, {child} FROM level{d} JOIN nodes{d} USING (tree, node))"
                f", walk{d + 1} AS (SELECT walk{d}.* REPLACE ({child.removesuffix(' AS node').replace('2 * node', f'2 * walk{d}.node').replace('ELSE node', f'ELSE walk{d}.node')} AS node) "
                f"FROM walk{d} JOIN nodes{d} ON walk{d}.tree = nodes{d}.tree AND walk{d}.node = nodes{d}.node)"
            )
    return (
        f"{sql}, lengths AS (SELECT tripId, sum(round((length(bin(w.node)) - 1 + {_path('size')}) * 1e9)::BIGINT) AS units "
        f"FROM walk{LEVELS} w JOIN nodes{LEVELS} l ON w.tree = l.tree AND w.node = l.node GROUP BY tripId), "
        f"scored AS (SELECT points.*, power(2.0::DOUBLE, -(units::DOUBLE / {TREES * 10**9}::DOUBLE) / "
        f"(SELECT {_path(f'least(n, {SAMPLE})')} FROM sizes)) AS score FROM points JOIN lengths USING (tripId)), "
        "labelled AS (SELECT *, round(score, 9) AS outlierScore, CASE WHEN score >= "
        "(SELECT quantile_disc(score, 0.999) FROM scored) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS predictedLabel FROM scored)"
    )


def _forest_outliers(columns: tuple[str, ...]) -> str:
    return (
        f"{_forest(columns)} SELECT tripId, {PAIR}, trip_distance, trip_duration, speed, outlierScore, predictedLabel "
        "FROM labelled WHERE predictedLabel = 1"
    )


def _forest_nodes(columns: tuple[str, ...]) -> str:
    every = " UNION ALL ".join(f"SELECT *, {d} AS depth FROM nodes{d}" for d in range(LEVELS + 1))
    return (
        f"{_forest(columns)}, every AS ({every}) SELECT tree::INTEGER AS tree, node, any_value(feature) AS feature, "
        "round(any_value(split), 9) AS split, any_value(size)::INTEGER AS size, min(depth)::INTEGER AS depth FROM every GROUP BY tree, node"
    )

ORACLES: dict[str, str] = {
    "profile_describe": f"{WITH_TRIPS} {_summary('trips', SUMMARY_COLUMNS)}",
    "profile_pairs_describe": (
        f"{WITH_PAIRS} {_summary('pairs', ('PULocationID', 'DOLocationID', 'count'))}"
    ),
    "null_rows": (
        f"{WITH_TRIPS} SELECT "
        + ", ".join(c for c in ORDER_TRIP_COLUMNS if not c.startswith("tpep_"))
        + ", CAST(epoch(date_trunc('second', tpep_pickup_datetime)) AS BIGINT) AS pickup_s"
        + ", CAST(epoch(date_trunc('second', tpep_dropoff_datetime)) AS BIGINT) AS dropoff_s"
        + " FROM trips WHERE "
        + " OR ".join(f"{c} IS NULL" for c in NULL_CHECK_COLUMNS)
    ),
    "custom_totals": (
        f"{WITH_TRIPS} SELECT round(sum(total_amount), 2) AS total_total_amount, "
        "round(sum(trip_distance), 2) AS total_trip_distance FROM trips"
    ),
    "avg_positive": (
        f"{WITH_TRIPS} SELECT round(avg(passenger_count), 2) AS average_passenger_count "
        "FROM trips WHERE passenger_count > 0"
    ),
    "pickup_counts": (
        f"{WITH_TRIPS} SELECT PULocationID, count(*) AS count FROM trips GROUP BY PULocationID"
    ),
    "dropoff_counts": (
        f"{WITH_TRIPS} SELECT DOLocationID, count(*) AS count FROM trips GROUP BY DOLocationID"
    ),
    "pair_counts": f"{WITH_PAIRS} SELECT * FROM pairs",
    "pair_counts_named": (
        f"{WITH_LOCATIONS}, pairs AS (SELECT {PAIR}, count(*) AS count FROM trips "
        f"GROUP BY {PAIR}) {_named_pairs('pairs')}"
    ),
    "top_pickups": _top_locations("PULocationID"),
    "top_dropoffs": _top_locations("DOLocationID"),
    "top_paths": (
        f"{WITH_LOCATIONS}, top AS (SELECT {PAIR}, count(*) AS count FROM trips "
        f"GROUP BY {PAIR} ORDER BY count DESC, {PAIR} LIMIT 10) {_named_pairs('top')}"
    ),
    "enriched": f"{WITH_ENRICHED} SELECT {ENRICHED}, speed FROM enriched",
    "enriched_amounts": (
        f"{WITH_ENRICHED} SELECT {ENRICHED}, speed, "
        "fare_amount / trip_distance AS amount_per_mile, "
        "fare_amount / trip_duration AS amount_per_second "
        "FROM enriched WHERE trip_distance > 0 AND fare_amount > 0"
    ),
    "scaled_features": (
        f"{WITH_ENRICHED} SELECT {ENRICHED}, "
        "round(speed / (SELECT stddev_samp(speed) FROM enriched), 6) AS scaled_speed, "
        "round(trip_distance / (SELECT stddev_samp(trip_distance) FROM enriched), 6) "
        "AS scaled_distance FROM enriched"
    ),
    "pair_totals": f"{WITH_TOTALS} SELECT * FROM totals",
    "ranked_pair_totals": (
        f"{WITH_TOTALS} SELECT *, row_number() OVER (ORDER BY total_amount DESC NULLS LAST, "
        f"{PAIR}) AS rank FROM totals"
    ),
    "pair_totals_struct": f"{WITH_TOTALS} SELECT * FROM totals",
    "top_pair_totals": (
        f"{WITH_TOTALS} SELECT * FROM totals ORDER BY total_amount DESC, {PAIR} LIMIT 10"
    ),
    "max_pair_total": f"{WITH_TOTALS} SELECT max(total_amount) AS max_total_amount FROM totals",
    "neighbour_totals_d1": _neighbours(1),
    "neighbour_totals_d2": _neighbours(2),
    "neighbour_totals_d15": _neighbours(15),
    "top_neighbour_totals": (
        f"SELECT * FROM ({_neighbours(1)}) "
        f"ORDER BY cumulated_total_amount DESC, {PAIR} LIMIT 10"
    ),
    "threshold_labels": f"{WITH_LABELS} SELECT * FROM labelled",
    "outlier_count": (
        f"{WITH_LABELS} SELECT count(*) AS outliers FROM labelled WHERE predictedLabel = 1"
    ),
    "clean_top_pairs": (
        f"{WITH_LABELS} SELECT {PAIR}, {EXACT_AMOUNT} AS total_amount FROM labelled "
        f"WHERE predictedLabel = 0 GROUP BY {PAIR} "
        f"ORDER BY total_amount DESC, {PAIR} LIMIT 10"
    ),
    "outliers_iforest": _forest_outliers(("speed",)),
    "outliers_iforest_two_features": _forest_outliers(("speed", "trip_distance")),
    "iforest_scores": f"{_forest(('speed',))} SELECT tripId, outlierScore, predictedLabel FROM labelled",
    "iforest_nodes": _forest_nodes(("speed", "trip_distance")),
    "successor_edges": f"WITH {EDGES} SELECT src, dst FROM edges",
    "graph_vertices": (
        f"WITH {EDGES}, ids AS (SELECT tripId AS id FROM trips WHERE trip_distance IS NOT NULL "
        "UNION SELECT src FROM edges UNION SELECT dst FROM edges) "
        "SELECT id, coalesce(trip_distance, 0.0::DOUBLE) "
        "AS weight FROM ids JOIN trips ON id = tripId"
    ),
    "chains_distance": f"{_chains('coalesce(trip_distance, 0.0::DOUBLE)')} {ALL_CHAINS}",
    "chains_trips": f"{_chains('1.0::DOUBLE')} {ALL_CHAINS}",
    "ranked_chains": (
        f"{_chains('coalesce(trip_distance, 0.0::DOUBLE)')} SELECT *, row_number() OVER "
        "(ORDER BY longestDistance DESC, tripID) AS rank FROM chains"
    ),
    "trip_chains_distance": f"{_chains('coalesce(trip_distance, 0.0::DOUBLE)')} {ALL_CHAINS}",
    "trip_chains_trips": f"{_chains('1.0::DOUBLE')} {ALL_CHAINS}",
    "chains_waiting": _chains(
        "1.0::DOUBLE",
        EDGES.replace("b.tripId AS dst ", f"b.tripId AS dst, {WAITED} AS nb ", 1),
        "e.nb",
    )
    + f" {ALL_CHAINS}",
    "place_cycles": (
        f"WITH RECURSIVE trips AS ({EVENT_TRIPS_SQL}), steps AS (SELECT DISTINCT PULocationID AS a, DOLocationID AS b "
        "FROM trips WHERE tpep_dropoff_datetime < tpep_pickup_datetime), "
        "reach(a, b) AS (SELECT a, b FROM steps UNION SELECT r.a, s.b FROM reach r JOIN steps s ON r.b = s.a) "
        "SELECT least(x.a, min(x.b)) AS cycle, x.a AS place FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a"
    ),
    "file_row_ids": "SELECT event_id, row_number() OVER () - 1 AS tripId FROM events",
    "csv_round_trip": (
        f"{WITH_TRIPS} SELECT * EXCLUDE (tpep_pickup_datetime, tpep_dropoff_datetime), "
        "CAST(epoch(date_trunc('second', tpep_pickup_datetime)) AS BIGINT) AS pickup_s, "
        "CAST(epoch(date_trunc('second', tpep_dropoff_datetime)) AS BIGINT) AS dropoff_s FROM trips"
    ),
    "chain_path": (
        f"{_chains('coalesce(trip_distance, 0.0::DOUBLE)')}, ends AS (SELECT tripID, row_number() OVER "
        "(ORDER BY longestDistance DESC, tripID) AS chain FROM chains "
        "ORDER BY chain LIMIT 3), "
        "walk(chain, trip, path, done) AS (SELECT chain, tripID, CAST(tripID AS VARCHAR), "
        "false FROM ends UNION ALL SELECT chain, previousTripID, "
        "CASE WHEN previousTripID = trip THEN path "
        "ELSE CAST(previousTripID AS VARCHAR) || ' > ' || path END, previousTripID = trip "
        "FROM walk JOIN chains ON trip = tripID WHERE NOT done) "
        "SELECT CAST(chain AS INTEGER) AS chain, path FROM walk WHERE done"
    ),
}
