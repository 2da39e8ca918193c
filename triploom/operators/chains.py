"""Heaviest chain of trips ending at every vertex of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.operators.contraction import contracted, expanded, runs_of
from triploom.operators.graph_blocks import block_sums
from triploom.operators.relaxation import BROADCAST_ROWS, hinted, positive_total, relax
from triploom.operators.skew import HOT_ROWS, Spread, split_hot_keys
from triploom.schema import TRIP_COLUMNS, TripColumns
from triploom.sources.checkpoints import cut_lineage
from triploom.sources.row_ids import with_file_row_id

BLOCK_ROWS = 500_000


def with_trip_id(
    df: DataFrame, id_col: str | None = None, cols: TripColumns = TRIP_COLUMNS
) -> DataFrame:
    """Add the trip id: an existing unique column, else row numbers in the order of the files.

    The row numbers depend on the files alone and not on their splits. A table that wasn't
    read from files gets Spark's own numbers, which change with the layout; store them with
    the table when they must stay.
    """
    if id_col:
        return df.withColumn(cols.trip_id, F.col(id_col).cast("long"))
    return with_file_row_id(df, cols.trip_id)


def trip_vertices(
    trips: DataFrame, weight: str = "distance", cols: TripColumns = TRIP_COLUMNS
) -> DataFrame:
    """Vertices ``(tripId, weight)``; a trip without a distance weighs 0.0."""
    return trips.select(
        F.col(cols.trip_id).cast("long").alias("tripId"),
        chosen_weight(weight, F.col(cols.distance).cast("double")).alias("weight"),
    )


def chosen_weight(weight: str, distance: Column) -> Column:
    """The weight of a trip: its distance, 0.0 if that is NULL, or 1.0 for each trip."""
    if weight == "distance":
        return F.coalesce(distance, F.lit(0.0))
    if weight == "count":
        return F.lit(1.0)
    raise ValueError(f"unknown weight {weight!r}; use 'distance' or 'count'")


def assemble_graph(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """All vertices ``(id, weight)``; one named only by an edge weighs 0.0."""
    nothing = F.lit(None).cast("double").alias("weight")
    ends = F.explode(F.array("src", "dst")).alias("id")
    return (
        vertices.select(F.col("tripId").alias("id"), "weight")
        .unionAll(edges.select(ends, nothing))
        .groupBy("id")
        .agg(F.coalesce(F.max("weight"), F.lit(0.0)).alias("weight"))
    )


def longest_chains(
    vertices: DataFrame,
    edges: DataFrame,
    weight: str = "distance",
    max_rounds: int | None = None,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    edge_weight: str | None = None,
    strategy: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(tripID, longestDistance, previousTripID)`` for every vertex of the graph.

    ``longestDistance`` is the largest sum of weights along a path that ends at the
    vertex; ``weight="count"`` counts trips instead. ``edge_weight`` names a column of
    ``edges`` that is added for every edge of the path, NULL as 0.0. ``previousTripID`` is
    the smallest id among the best predecessors, or the vertex itself when none adds weight.

    ``strategy="contracted"`` draws runs of single successors together and settles blocks
    of ``block_rows`` edges in tasks, so rounds count the blocks that a best path crosses;
    a graph within one block takes one round and no contraction. Sums along a run are added
    pairwise, which may round otherwise than adding them in order.
    ``strategy="frontier"`` sends what rose one edge on per round; it is taken where
    ``max_rounds`` limits the rounds. A cycle raises once a sum outweighs everything that a
    path without repeats can hold. Edges carry the weight of their source, so the vertex
    table itself takes no part in the rounds.
    """
    strategy = strategy or ("contracted" if max_rounds is None else "frontier")
    if strategy not in ("contracted", "frontier"):
        raise ValueError(f"unknown strategy {strategy!r}; use 'contracted' or 'frontier'")
    own = F.coalesce(F.col(edge_weight).cast("double"), F.lit(0.0)) if edge_weight else F.lit(0.0)
    # read by the assembly, the count of hot keys and the links
    edges = cut_lineage(edges.select("src", "dst", own.alias("extra")))
    graph = cut_lineage(
        assemble_graph(vertices, edges).select(
            "id", chosen_weight(weight, F.col("weight")).alias("weight")
        )
    )
    links, spread, keys = split_hot_keys(
        edges.select(F.col("src").alias("id"), "dst", "extra"), ["id"], "dst", hot_rows=hot_rows
    )
    links = links.join(spread(graph), keys).withColumn("weight", F.col("weight") + F.col("extra"))
    links = cut_lineage(links.drop("extra"))
    ceiling = positive_total(graph)
    if edge_weight:
        ceiling += positive_total(edges.groupBy("dst").agg(F.max("extra").alias("extra")), "extra")
    if strategy == "frontier":
        raised = _frontier_sums(links, spread, keys, ceiling, max_rounds, broadcast_rows)
    else:
        raised = _contracted_sums(
            links, spread, keys, ceiling, block_rows, hot_rows, broadcast_rows
        )
    # every sum is final now, so the best offer to a vertex is what it holds
    state = cut_lineage(
        graph.join(raised, "id", "left").withColumn("cum", F.coalesce("cum", F.lit(0.0)))
    )
    reach = F.col("weight") + F.col("cum")
    fathers = (
        links.join(spread(state.select("id", "cum")), keys)
        .filter(reach > 0)
        .groupBy(F.col("dst").alias("id"))
        .agg(F.min(F.struct(-reach, F.col("id"))).getField("id").alias("father"))
    )
    return state.join(fathers, "id", "left").select(
        F.col("id").alias("tripID"),
        reach.alias("longestDistance"),
        F.coalesce("father", "id").alias("previousTripID"),
    )


def _frontier_sums(
    links: DataFrame,
    spread: Spread,
    keys: list[str],
    ceiling: float,
    max_rounds: int | None,
    broadcast_rows: int,
) -> DataFrame:
    """Largest sum brought to each vertex; each round sends those that rose along their edges."""
    reach = F.col("weight") + F.col("cum")

    def offers(sent: DataFrame) -> DataFrame:
        return sent.filter(reach > 0).select(F.col("dst").alias("id"), reach.alias("cum"))

    def propose(frontier: DataFrame, small: bool) -> DataFrame:
        ready = spread(frontier)
        fits = small and (
            ready is frontier or ready.limit(broadcast_rows + 1).count() <= broadcast_rows
        )
        return offers(links.join(hinted(ready, fits), keys))

    first = offers(links.withColumn("cum", F.lit(0.0)))
    first = first.groupBy("id").agg(F.max("cum").alias("cum"))
    return relax(first, ["id"], propose, ceiling, max_rounds, broadcast_rows)


def _contracted_sums(
    links: DataFrame,
    spread: Spread,
    keys: list[str],
    ceiling: float,
    block_rows: int,
    hot_rows: int,
    broadcast_rows: int,
) -> DataFrame:
    """Largest sum brought to each vertex, of a graph with its runs drawn together."""
    links = links.filter("dst is not null")
    none = F.lit(None).cast("double").alias("b")
    if links.limit(block_rows + 1).count() <= block_rows:
        edges = links.select(F.col("id").alias("src"), "dst", F.col("weight").alias("a"), none)
        return block_sums(edges, ceiling, block_rows, hot_rows, broadcast_rows)
    runs = cut_lineage(runs_of(links))
    edges = cut_lineage(contracted(links, runs, spread, keys))
    sums = block_sums(edges, ceiling, block_rows, hot_rows, broadcast_rows)
    return expanded(sums, runs)
