"""Shortest time until the price is next higher and next lower, within a horizon.

``forward_pairs`` is the interval join itself. ``shortest_windows`` needs only the first higher and the first lower
tick, and finds them without forming pairs:

* A symbol's ticks are cut into blocks one horizon long. A later tick within the horizon lies in the same or in the
  next block, so each block gets its own ticks (home) and a copy of the next block's.
* Number the distinct times of a block 0, 1, 2, ... Any two numbers differ first (from the top) in exactly one bit; the
  earlier tick has 0 there and the later one 1. So for each bit the block falls into nodes (equal higher bits) in which
  every tick with bit 1 is later than every tick with bit 0. One more node holds the home ticks against the copies.
* Within a node time order is settled and only price order is left: sorted by price, the first higher tick is a running
  minimum of the times of the ticks with bit 1.

That is one row per tick and bit, sorted, instead of one row per pair: n log n rather than n squared in a block.

A block is the unit of work. One that holds very many ticks can do so only with many prices per instant, as instants
are microseconds; of these only the highest and the lowest price can be anybody's answer. So the ticks of busy blocks
are dealt out as questions to as many shares as their number asks for, and each share gets a copy of these two prices
per instant. The busy blocks, however many, are a stored table of their own: from its size Spark knows before the join
whether to send it to all tasks or to shuffle.

The rows of the nodes and the pairs are many more than what is shuffled for them, so from the shuffled bytes Spark would
plan too few tasks. Both operators count the ticks of the blocks first and deal their work out to as many tasks as the
number of rows asks for, so that a task's memory and time do not grow with the input.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.timegrid import floor_div, grid_index
from tickflow.operators.ticks import valid_ticks
from tickflow.plans.params import TickParams, interval, micros
from tickflow.sources.tables import stored

#: Blocks above this number of ticks are split into shares of about this size.
BUSY_BLOCK = 4_000_000
#: Rows of nodes and pairs that one task is to get, about.
NODE_ROWS = 500_000
PAIR_ROWS = 5_000_000
#: A tick without any pair is as much work as so many pairs.
TICK_PAIRS = 10
#: Ticks are dealt out for their pairs by spans of time, of whole quarters of a horizon, at most so many: each span with
#: about an eighth of a task's pairs, or a thousandth of all.
QUARTERS = 4
MOST_QUARTERS = 128
SPANS_OF_TASK = 8
PAIR_SPANS = 1_000


def block_counts(ticks: DataFrame, params: TickParams) -> DataFrame:
    """(symbol, block, count) of the blocks of one horizon; reads two columns and counts before the shuffle."""
    return ticks.groupBy("symbol", grid_index(F.col("event_time"), params.horizon).alias("block")).count()


def _tasks(counts: DataFrame, rows: Column, rows_of_task: int) -> int:
    """How many tasks the work on blocks asks for, of ``rows`` rows each."""
    return max(1, math.ceil((counts.agg(F.sum(rows)).first()[0] or 0) / rows_of_task))


def _pair_spans(counts: DataFrame) -> tuple[int, int]:
    """How many tasks the pairs of the blocks ask for, and how many quarters of a horizon a span has for them."""
    # A tick meets about as many later ticks as its block holds, and is itself some work.
    pairs = F.col("count").cast("double") * (F.col("count") + TICK_PAIRS)
    total, most = (x or 0 for x in counts.agg(F.sum(pairs), F.max(pairs)).first())
    of_span = max(PAIR_ROWS / SPANS_OF_TASK, total / PAIR_SPANS)
    quarters = min(QUARTERS * of_span / max(most, 1), MOST_QUARTERS)
    return max(1, math.ceil(total / max(PAIR_ROWS, of_span))), max(1, int(quarters))


def forward_pairs(
    ticks: DataFrame, params: TickParams, shown: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Each tick with every later tick of its symbol up to ``horizon`` away; right columns NULL if there is none.

    The later ticks are a frame of the ticks in order of time, made into rows. Ticks are shuffled once, by (symbol, span
    of time): a tick lies in its own span and, for those before it, in each that reaches it. Spans are as long as their
    number of pairs allows, so that few ticks lie in several. ``shown``, row by row, gives prices and times the form the
    result is to have: it is applied to the ticks, which are fewer than the pairs.

    The pre-count of the blocks runs when this is called.
    """
    ticks = valid_ticks(ticks).select("symbol", "price", "event_time")
    named = ticks.filter(F.col("symbol").isNotNull())
    tasks, quarters = _pair_spans(block_counts(named, params))

    horizon = micros(params.horizon)
    span = quarters * -(-horizon // QUARTERS)
    at = F.unix_micros("event_time")
    spans = F.sequence(floor_div(at - horizon, span), floor_div(at, span))
    # The symbol is made with the span: were it a constant, Spark would leave it out of the frames and shuffle again.
    places = F.transform(spans, lambda n: F.struct(F.col("symbol"), n.alias("span")))
    placed = named.select("price", "event_time", F.inline(places)).repartition(tasks, "symbol", "span")

    rows = placed.select("symbol", "span", "price", "event_time", at.alias("at"))
    rows = rows if shown is None else shown(rows)
    right = F.struct(F.col("price").alias("right_price"), F.col("event_time").alias("right_time"))
    reach = Window.partitionBy("symbol", "span").orderBy("at").rangeBetween(1, horizon)
    later = rows.withColumn("later", F.collect_list(right).over(reach)).filter(floor_div(F.col("at"), span) == F.col("span"))
    pairs = later.select("symbol", "price", "event_time", F.inline_outer("later"))
    # Without a symbol nothing is equal, so nothing is found.
    alone = ticks.filter(F.col("symbol").isNull())
    alone = alone if shown is None else shown(alone)
    nothing = [F.lit(None).cast(pairs.schema[name].dataType).alias(name) for name in ("right_price", "right_time")]
    return pairs.unionByName(alone.select("symbol", "price", "event_time", *nothing))


def pair_condition(horizon: timedelta) -> Column:
    """Same symbol and block, strictly later, at most ``horizon`` later."""
    return (
        (F.col("symbol") == F.col("right_symbol"))
        & (F.col("block") == F.col("right_block"))
        & (F.col("right_time") > F.col("event_time"))
        & (F.col("right_time") <= F.col("event_time") + F.expr(f"INTERVAL {interval(horizon)}"))
    )


def first_in_pairs(pairs: DataFrame) -> DataFrame:
    """First higher and first lower time per tick; equal ticks (symbol, time, price) become one row."""
    return pairs.groupBy("symbol", "event_time", "price").agg(
        F.min(F.when(F.col("right_price") > F.col("price"), F.col("right_time"))).alias("first_higher"),
        F.min(F.when(F.col("right_price") < F.col("price"), F.col("right_time"))).alias("first_lower"),
    )


def busy_blocks(ticks: DataFrame, params: TickParams, busy_block: int) -> DataFrame:
    """(symbol, block, shares) of the blocks with more than ``busy_block`` ticks."""
    return _busy(block_counts(ticks, params), busy_block)


def _busy(counts: DataFrame, busy_block: int) -> DataFrame:
    shares = F.ceil(F.col("count") / busy_block).cast("int")
    return counts.filter(F.col("count") > busy_block).select("symbol", "block", shares.alias("shares"))


def _place(block: str, share: str, asks: bool, answers: bool, home: bool) -> str:
    flags = f"'asks', {asks}, 'answers', {answers}, 'home', {home}"
    return f"named_struct('block', {block}, 'share', {share}, {flags})"


def _placed(ticks: DataFrame, params: TickParams, busy_block: int, counts: DataFrame | None = None) -> DataFrame:
    """Distinct ticks by (symbol, block, share), as question (``asks``) and/or possible answer (``answers``).

    ``home`` tells the block's own ticks from the copies of the next block's.
    """
    busy = stored(_busy(block_counts(ticks, params) if counts is None else counts, busy_block))
    own = busy.withColumnRenamed("shares", "own_shares")
    previous = busy.select("symbol", (F.col("block") + 1).alias("block"), F.col("shares").alias("previous_shares"))
    block = grid_index(F.col("event_time"), params.horizon)

    def shares_of_both(rows: DataFrame, how: str) -> DataFrame:
        return rows.withColumn("block", block).join(own, ["symbol", "block"], how).join(
            previous, ["symbol", "block"], "left"
        )

    dealt = "CAST(pmod(xxhash64(event_time, price), own_shares) AS INT)"
    to_previous = f"""
        transform(sequence(0, coalesce(previous_shares, 1) - 1),
                  s -> {_place("block - 1", "s", asks=False, answers=True, home=False)})"""
    to_own = f"""
        transform(sequence(0, own_shares - 1),
                  s -> {_place("block", "s", asks=False, answers=True, home=True)})"""
    places = f"""
        CASE WHEN own_shares IS NOT NULL
             THEN array({_place("block", dealt, asks=True, answers=False, home=True)})
             ELSE concat(array({_place("block", "0", asks=True, answers=True, home=True)}), {to_previous}) END"""
    questions = shares_of_both(ticks.distinct(), "left").selectExpr(
        "symbol", "event_time", "price", f"inline({places})"
    )
    extremes = (
        shares_of_both(ticks, "inner")
        .groupBy("symbol", "block", "event_time", "own_shares", "previous_shares")
        .agg(F.array_distinct(F.array(F.max("price"), F.min("price"))).alias("prices"))
        .withColumn("price", F.explode("prices"))
        .selectExpr("symbol", "event_time", "price", f"inline(concat({to_own}, {to_previous}))")
    )
    return questions.unionByName(extremes)


def first_higher_lower(ticks: DataFrame, params: TickParams, busy_block: int = BUSY_BLOCK) -> DataFrame:
    """(symbol, event_time, price, first_higher, first_lower) without forming pairs; see the module text.

    The pre-count of the blocks runs when this is called, and its table is written to the session's shared folder.
    """
    valid = valid_ticks(ticks).select("symbol", "event_time", "price")
    named = valid.filter(F.col("symbol").isNotNull())
    counts = stored(block_counts(named, params))
    # A tick comes once for each digit of its number, once in the node of the block, and once as a copy.
    tasks = _tasks(counts, F.col("count") * (F.length(F.bin("count")) + 2), NODE_ROWS)
    unit = ("symbol", "block", "share")
    placed = _placed(named, params, busy_block, counts).repartition(tasks, *unit)

    by_time = Window.partitionBy(*unit).orderBy(F.col("home").desc(), "event_time")
    whole_block = Window.partitionBy(*unit)
    numbered = (
        placed.withColumn("number", (F.dense_rank().over(by_time) - 1).cast("bigint"))
        .withColumn("last", F.max(F.when(F.col("home"), F.col("number"))).over(whole_block))
        # A block of copies only has nobody to answer.
        .filter(F.col("last").isNotNull())
    )
    bits = F.length(F.bin("last"))
    levels = F.when(F.col("home"), F.sequence(F.lit(-1), bits - 1)).otherwise(F.array(F.lit(-1)))
    in_nodes = numbered.select("*", F.explode(levels).alias("level")).select(
        *unit,
        "event_time",
        "price",
        "asks",
        "answers",
        "level",
        F.expr("IF(level < 0, 0L, shiftright(number, level + 1))").alias("node"),
        F.expr("IF(level < 0, NOT home, (shiftright(number, level) & 1L) = 1L)").alias("later"),
    )

    # At equal prices the earlier ticks come first and so do not see the later ones.
    node = Window.partitionBy("node", "level", *unit)
    found = F.min(F.when(F.col("later") & F.col("answers"), F.col("event_time")))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    asked = F.col("asks") & ~F.col("later")
    answers = in_nodes.withColumns(
        {
            "first_higher": found.over(node.orderBy(F.col("price").desc(), "later").rowsBetween(*so_far)),
            "first_lower": found.over(node.orderBy(F.col("price").asc(), "later").rowsBetween(*so_far)),
        }
    ).filter(asked)

    # Every question is asked in the top node, so none is lost.
    firsts = answers.groupBy(*unit, "event_time", "price").agg(
        F.min("first_higher").alias("first_higher"), F.min("first_lower").alias("first_lower")
    )
    latest = F.col("event_time") + F.expr(f"INTERVAL {interval(params.horizon)}")
    in_reach = {
        name: F.when(F.col(name) <= latest, F.col(name))
        for name in ("first_higher", "first_lower")
    }
    found = firsts.withColumns(in_reach).drop("block", "share")
    # Without a symbol nothing is equal, so nothing is found.
    nothing = {name: F.lit(None).cast("timestamp") for name in in_reach}
    return found.unionByName(valid.filter(F.col("symbol").isNull()).distinct().withColumns(nothing))


def as_windows(firsts: DataFrame, params: TickParams, with_found: bool = False) -> DataFrame:
    """First times to seconds as float; the horizon itself stands for "none found".

    ``with_found`` adds flags that tell that apart from a hit at exactly the horizon.
    """
    none_found = F.lit(micros(params.horizon) / 1e6)
    start = F.col("event_time").cast("double")
    columns = [F.col("event_time").alias("timestamp"), F.col("symbol")]
    for side in ("higher", "lower"):
        first = F.col(f"first_{side}")
        seconds = F.when(first.isNotNull(), first.cast("double") - start).otherwise(none_found)
        columns.append(seconds.cast("float").alias(f"{side}_window"))
        if with_found:
            columns.append(first.isNotNull().alias(f"{side}_found"))
    return firsts.select(*columns)


def shortest_windows(ticks: DataFrame, params: TickParams, with_found: bool = False) -> DataFrame:
    return as_windows(first_higher_lower(ticks, params), params, with_found)
