"""Heaviest chains straight from the trips, without a table of edges.

The number of edges grows with the square of the trips per place and hour. What a trip
can inherit, though, depends on its pickup place and time alone: the largest sum brought
to that place within the idle limit before. So the loop runs over the distinct pickup
points, and each round takes a maximum over a time window instead of joining pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triploom.functions import any_null, none_null
from triploom.operators.blocks import block_settler, cut_into_blocks, in_zones, slab_of, zone_of
from triploom.operators.chains import chosen_weight
from triploom.operators.relaxation import (
    BROADCAST_ROWS,
    COMPACT_EVERY,
    checked_count,
    hinted,
    latest,
    positive_total,
    relax,
    rise,
)
from triploom.operators.scan import running_max
from triploom.operators.skew import HOT_ROWS, split_hot_keys
from triploom.operators.successors import (
    idle_window,
    seconds_of,
    slot_of,
    trip_table,
)
from triploom.schema import TRIP_COLUMNS, TripColumns
from triploom.sources.checkpoints import cut_lineage

POINT = ["place", "time"]
ARRIVAL = ["to_place", "to_time"]
CELL = ["place", "slot"]
BLOCK_ROWS = 500_000
CELL_ROWS = 200_000


def trip_chains(
    trips: DataFrame,
    max_idle_s: float = 300,
    weight: str = "distance",
    invalid_trips: str = "isolate",
    strategy: str = "blocked",
    max_rounds: int | None = None,
    block_rows: int = BLOCK_ROWS,
    wave: int | None = None,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    cell_rows: int = CELL_ROWS,
    cols: TripColumns = TRIP_COLUMNS,
) -> DataFrame:
    """``(tripID, longestDistance, previousTripID)`` for every trip.

    The same result as ``longest_chains`` over ``successor_edges``: one row per trip,
    a NULL distance weighs 0.0, ties between predecessors go to the smallest id.

    ``strategy="frontier"`` moves all chains on by one trip per round.
    ``strategy="blocked"`` moves them on inside slabs of time, each of which a task can
    hold, from one slab to the next in zones, and exchanges only what leaves a zone: as many
    rounds as a best chain crosses zones, which don't grow in number with the trips.

    Where more than ``cell_rows`` trips start or end at one place within an idle limit, its
    arrivals are scanned by as many tasks as that takes; others by a window each.
    """
    if strategy not in ("blocked", "frontier"):
        raise ValueError(f"unknown strategy {strategy!r}; use 'blocked' or 'frontier'")
    width = idle_window(max_idle_s)
    table = cut_lineage(
        trip_table(trips, invalid_trips, cols).select(
            "id",
            F.col("pu").alias("place"),
            F.col("pickup").alias("time"),
            F.col("do").alias("to_place"),
            F.col("dropoff").alias("to_time"),
            chosen_weight(weight, F.col("distance")).alias("weight"),
        )
    )
    starts = table.filter(none_null(POINT))
    loose = table.filter(any_null(POINT))
    legs = (
        starts.filter(none_null(ARRIVAL))
        .groupBy(*POINT, *ARRIVAL)
        .agg(F.max("weight").alias("weight"))
    )
    # trips without a pickup point inherit nothing, but may be the start of a chain
    unplaced = _arrivals(loose.withColumn("cum", F.lit(0.0)), F.max(_reach()))
    ceiling = positive_total(table)
    hot = hot_cells(table, width, cell_rows)
    if strategy == "frontier":
        sums = _frontier_sums(
            legs, unplaced, width, ceiling, max_rounds, hot_rows, broadcast_rows, hot
        )
    else:
        sums = _blocked_sums(
            legs, unplaced, width, ceiling, max_rounds, block_rows, hot_rows, broadcast_rows, wave, hot
        )

    starts, spread, keys = split_hot_keys(starts, POINT, "id", hot_rows=hot_rows)
    starts = starts.join(spread(sums), keys, "left").na.fill(0.0, ["cum"])
    columns = ["id", *ARRIVAL, "weight"]
    starts = cut_lineage(starts.select(*keys, *columns, "cum"))
    loose = loose.select(*columns, F.lit(0.0).alias("cum"))

    # all sums are final now, so the best arrival at a point is what it holds
    brought = F.max(F.struct(_reach().alias("sum"), (-F.col("id")).alias("minus_id")))
    senders = starts.select(*columns, "cum").unionAll(loose)
    points = starts.select(*POINT).distinct()
    fathers = _best_arrival(points, _arrivals(senders, brought), width, False, hot)
    fathers = fathers.select(
        *POINT, F.col("cum.sum").alias("sum"), (-F.col("cum.minus_id")).alias("father")
    )
    linked = starts.join(spread(fathers), keys, "left").select(
        F.col("id").alias("tripID"),
        (F.col("weight") + F.coalesce("sum", F.lit(0.0))).alias("longestDistance"),
        F.coalesce("father", "id").alias("previousTripID"),
    )
    return linked.unionAll(loose.select("id", "weight", "id"))


def _frontier_sums(
    legs: DataFrame,
    unplaced: DataFrame,
    width: int,
    ceiling: float,
    max_rounds: int | None,
    hot_rows: int,
    broadcast_rows: int,
    hot: DataFrame | None,
) -> DataFrame:
    """Largest sum brought to each pickup point, one hop per round."""
    legs, spread, keys = split_hot_keys(legs, POINT, "to_time", hot_rows=hot_rows)
    legs = cut_lineage(legs)
    points = cut_lineage(legs.select(*POINT).distinct())

    def propose(frontier: DataFrame, small: bool) -> DataFrame:
        ready = spread(frontier)
        fits = small and (
            ready is frontier or ready.limit(broadcast_rows + 1).count() <= broadcast_rows
        )
        sent = legs.join(hinted(ready, fits), keys)
        # a point may send many arrivals, which are not counted: no hint for them
        return _best_arrival(points, _arrivals(sent, F.max(_reach())), width, False, hot)

    sent = _arrivals(legs.withColumn("cum", F.lit(0.0)), F.max(_reach()))
    first = sent.unionAll(unplaced).groupBy(*POINT).agg(F.max("value").alias("value"))
    first = _best_arrival(points, first, width, False, hot)
    return relax(first, POINT, propose, ceiling, max_rounds, broadcast_rows)


def _blocked_sums(
    legs: DataFrame,
    unplaced: DataFrame,
    width: int,
    ceiling: float,
    max_rounds: int | None,
    block_rows: int,
    hot_rows: int,
    broadcast_rows: int,
    wave: int | None,
    hot: DataFrame | None,
) -> DataFrame:
    """Largest sum brought to each pickup point, one zone of time per round.

    A zone is a row of slabs, which one task settles one after the other; there are as many
    zones as keep the tasks busy, whatever the number of legs. Sums only grow, so zones may
    run in any order and as often as needed: a zone runs again when an arrival from outside
    raises one of its points. All run in the first round; later at most ``wave`` zones do,
    because what a zone finds is soon out of date while many before it still change.
    """
    spark = legs.sparkSession
    zones = 2 * spark.sparkContext.defaultParallelism
    wave = wave or max(64, zones)
    legs, cut = cut_into_blocks(cut_lineage(legs), block_rows, zones)
    legs, spread, keys = split_hot_keys(
        legs, POINT, "to_time", "point_salt", hot_rows=hot_rows
    )
    points = cut_lineage(legs.select(*POINT).distinct())
    settle = block_settler(width, cut, block_rows)
    place_type = legs.schema["place"].dataType.simpleString()
    news = f"settled boolean, place {place_type}, time long, value double"

    def zoned(df: DataFrame) -> DataFrame:
        slab = slab_of("time", cut.first, cut.length)
        return df.withColumn("slab", slab).withColumn("zone", zone_of("slab", cut.span)).drop("slab")

    nothing = zoned(points.select(*POINT, F.lit(0.0).alias("cum"))).limit(0)

    rows = legs.withColumns({"cum": F.lit(0.0), "fresh": F.lit(True)})
    waiting = nothing
    raised: list[DataFrame] = []
    total = 0
    rounds = 0
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        told = cut_lineage(in_zones(rows).mapInPandas(settle, news))
        raised.append(told.filter("settled").select(*POINT, F.col("value").alias("cum")))
        sent = told.filter("not settled").select(*POINT, "value")
        if rounds == 1:
            sent = sent.unionAll(unplaced)
        total += checked_count(told, "value", ceiling)
        sent = cut_lineage(sent.groupBy(*POINT).agg(F.max("value").alias("value")))
        # each arrival stands in two slots
        fits = 2 * sent.count() <= broadcast_rows
        offers = _best_arrival(points, sent, width, fits, hot)
        frontier = rise(offers, raised, POINT, total, broadcast_rows)
        total += frontier.count()

        # zones with a raised point run again, the earliest first
        queue = waiting.unionAll(zoned(frontier))
        due = queue.select("zone").distinct().orderBy("zone").limit(wave + 1).collect()
        if not due:
            return latest(raised, POINT)
        woken = F.broadcast(spark.createDataFrame(due[:wave], "zone long"))
        later = queue.filter(F.col("zone") > due[:wave][-1]["zone"])
        waiting = cut_lineage(later) if len(due) > wave else nothing
        known = reduce(
            DataFrame.unionAll,
            [zoned(r.select(*POINT, "cum", F.lit(False).alias("fresh"))) for r in raised],
            queue.select(*POINT, "cum", F.lit(True).alias("fresh"), "zone"),
        )
        known = (
            known.join(woken, "zone", "left_semi")
            .groupBy(*POINT)
            .agg(F.max("cum").alias("cum"), F.max("fresh").alias("fresh"))
        )
        ready = spread(known)
        fits = total <= broadcast_rows and (
            ready is known or ready.limit(broadcast_rows + 1).count() <= broadcast_rows
        )
        rows = (
            legs.join(woken, "zone", "left_semi")
            .join(hinted(ready, fits), keys, "left")
            .na.fill(0.0, ["cum"])
            .na.fill(False, ["fresh"])
        )
        raised.append(frontier)
        if len(raised) > COMPACT_EVERY:
            raised = [cut_lineage(latest(raised, POINT))]
    raise RuntimeError(f"chains still grow after max_rounds={max_rounds}")


def _reach() -> Column:
    return F.col("weight") + F.col("cum")


def _arrivals(senders: DataFrame, value: Column) -> DataFrame:
    """Largest value brought to each drop-off place and time: ``(place, time, value)``."""
    return (
        senders.filter(none_null(ARRIVAL) & (_reach() > 0))
        .groupBy(*ARRIVAL)
        .agg(value.alias("value"))
        .select(F.col("to_place").alias("place"), F.col("to_time").alias("time"), "value")
    )


def hot_cells(trips: DataFrame, width: int, cell_rows: int) -> DataFrame | None:
    """The cells (place, slot) that more than ``cell_rows`` trips start or end in, or None.

    No round can bring more rows to a cell than these. Counting combines inside the input
    partitions first.
    """
    own, ended = slot_of("time", width), slot_of("to_time", width)
    begun = trips.filter(none_null(POINT)).select("place", own.alias("slot"))
    slots = F.explode(F.array(ended, ended + width)).alias("slot")
    arrived = trips.filter(none_null(ARRIVAL)).select(F.col("to_place").alias("place"), slots)
    full = begun.unionAll(arrived).groupBy(*CELL).agg(F.count(F.lit(1)).alias("rows"))
    full = cut_lineage(full.filter(F.col("rows") > cell_rows).select(*CELL))
    found = full.limit(BROADCAST_ROWS + 1).count()
    return hinted(full, found <= BROADCAST_ROWS) if found else None


def _best_arrival(
    points: DataFrame, arrivals: DataFrame, width: int, small: bool, hot: DataFrame | None = None
) -> DataFrame:
    """The points that an arrival can reach, and the largest value in reach as ``cum``.

    Time is cut into slots as long as the idle limit. A point sees the arrivals of its
    own slot that precede it, and those of the slot before that are recent enough. Both
    are running maxima in order of time over one place and slot: in a window, which holds at
    most one row per distinct time on either side, or, for the ``hot`` cells, over as many
    tasks as the cell needs.
    """
    own_slot = slot_of("time", width)
    slots = F.inline(
        F.array(
            F.struct(own_slot.alias("slot"), F.lit(True).alias("same")),
            F.struct((own_slot + width).alias("slot"), F.lit(False).alias("same")),
        )
    )
    cells = arrivals.select("place", "time", "value", slots)
    # the filter keeps `value`, so that both uses of the arrivals share one exchange
    touched = hinted(cells.filter("value is not null").select(*CELL), small)
    placed = points.withColumn("slot", own_slot)
    near = placed.join(touched, CELL, "left_semi")
    if hot is None:
        return _in_windows(_asked(near, cells, width))
    others = [df.join(hot, CELL, "left_anti") for df in (near, cells)]
    rows = _asked(*(df.join(hot, CELL, "left_semi") for df in (placed, cells)), width)
    return _in_windows(_asked(*others, width)).unionAll(_in_pieces(rows))


def _asked(points: DataFrame, cells: DataFrame, width: int) -> DataFrame:
    """Points and arrivals in one table: a point has no ``same``; ``age`` falls with time."""
    second = seconds_of("time")
    value_type = cells.schema["value"].dataType
    return points.select(
        *CELL,
        "time",
        (F.lit(width - 1) - second).alias("age"),
        F.lit(None).cast("boolean").alias("same"),
        F.lit(None).cast(value_type).alias("value"),
    ).unionAll(cells.select(*CELL, "time", (-second).alias("age"), "same", "value"))


def _in_windows(rows: DataFrame) -> DataFrame:
    by_cell = Window.partitionBy(*CELL)
    before = by_cell.orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    recent = by_cell.orderBy("age").rangeBetween(Window.unboundedPreceding, 0)
    best = F.greatest(
        F.max(F.when(F.col("same"), F.col("value"))).over(before),
        F.max(F.when(~F.col("same"), F.col("value"))).over(recent),
    )
    return _reached(rows.withColumn("cum", best))


def _in_pieces(rows: DataFrame) -> DataFrame:
    """The same two maxima; a point precedes arrivals of its time and follows those of its age."""
    point = F.col("same").isNull()
    rows = rows.withColumn("turn", F.when(point, 0).otherwise(1))
    own = rows.filter("same is null or same")
    own = running_max(own, CELL, ["time", "turn"], "value").filter("same is null")
    earlier = rows.filter("same is null or not same").withColumn("turn", -F.col("turn"))
    earlier = running_max(earlier, CELL, ["age", "turn"], "value").filter("same is null")
    found = own.unionAll(earlier).withColumn("cum", F.col("best")).filter("cum is not null")
    return found.groupBy(*POINT).agg(F.max("cum").alias("cum"))


def _reached(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("same").isNull() & F.col("cum").isNotNull()).select(*POINT, "cum")
