"""The queries of the catalogue as plain SQL, for an independent engine over the same tables.

Each is the definition written out (every tick against every window or later tick), with no part of the library's
method in it.
"""

from __future__ import annotations

from tickflow.plans.catalog import SHORT_WINDOWS, OUTLIER_THRESHOLD, WAVES
from tickflow.plans.params import REFERENCE, SCALED, TickParams, micros


def _span(duration) -> str:
    return f"to_microseconds({micros(duration)})"


def _rounded(expression: str, digits: int = 6) -> str:
    return f"round(({expression}) + 1e-9, {digits})"


def _moving_cte(params: TickParams = SCALED, source: str = "events") -> str:
    """m: unrounded moving statistics of the ticks of ``source``, one row per symbol and window end."""
    shortest = params.panes(params.labels[0])
    stats = ", ".join(
        f"avg(value) FILTER (WHERE i <= {params.panes(w)}) AS avg_{w}, "
        f"stddev_samp(value) FILTER (WHERE i <= {params.panes(w)}) AS std_{w}"
        for w in params.labels
    )
    longest = params.panes(params.labels[-1])
    slide = _span(params.slide)
    return f"""m AS (
      SELECT symbol, "timestamp", {stats}
      FROM (SELECT event_type AS symbol, i, value, time_bucket({slide}, ts) + i * {slide} AS "timestamp"
            FROM {source}, range(1, {longest + 1}) AS r(i)) AS x
      GROUP BY symbol, "timestamp"
      HAVING count(*) FILTER (WHERE i <= {shortest}) > 0)"""


def _moving(params: TickParams = SCALED, where: str = "TRUE") -> str:
    columns = ", ".join(
        f"{_rounded(f'{kind}_{w}')} AS {kind}_{w}" for w in params.labels for kind in ("avg", "std")
    )
    return f'WITH {_moving_cte(params)} SELECT symbol, "timestamp", {columns} FROM m WHERE {where}'


def _moving_single(label: str, params: TickParams = SCALED) -> str:
    return f"""WITH {_moving_cte(params.only(label))}
      SELECT symbol, "timestamp", {_rounded(f"avg_{label}")} AS avg_price, {_rounded(f"std_{label}")} AS std_price
      FROM m"""


def _moving_rows(columns: str = "avg_price, std_price") -> str:
    union = " UNION ALL ".join(
        f"""SELECT "timestamp", symbol, '{w}' AS "window", {_rounded(f"avg_{w}")} AS avg_price,
            {_rounded(f"std_{w}")} AS std_price FROM m"""
        for w in SCALED.labels
    )
    return f'WITH {_moving_cte()} SELECT "timestamp", symbol, "window", {columns} FROM ({union}) AS u'


def _zscore_cte() -> str:
    """z: unrounded z-scores, one row per tick next to a window end."""
    tolerance = _span(SCALED.tolerance)
    scores = ", ".join(f"(e.value - m.avg_{w}) / nullif(m.std_{w}, 0) AS z_{w}" for w in SCALED.labels)
    return f"""{_moving_cte()}, z AS (
      SELECT e.ts AS "timestamp", e.event_type AS symbol, m."timestamp" AS window_end, {scores}
      FROM events AS e JOIN m ON e.event_type = m.symbol
       AND e.ts >= m."timestamp" - {tolerance} AND e.ts <= m."timestamp" + {tolerance})"""


def _zscore_rows(time: str = '"timestamp"', where: str = "TRUE", more: str = "") -> str:
    union = " UNION ALL ".join(
        f"""SELECT {time} AS "timestamp", symbol, '{w}' AS "window", z_{w} AS zscore FROM z WHERE {where}"""
        for w in SCALED.labels
    )
    return f"""WITH {_zscore_cte()}
      SELECT "timestamp", symbol, "window", {_rounded("zscore", 4)} AS zscore_price{more} FROM ({union}) AS u"""


MILLIS = "date_trunc('milliseconds', {})"
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
LAST = MILLIS.format("(SELECT max(ts) FROM events)")
LAST_SLIDE = f"time_bucket({_span(SCALED.slide)}, (SELECT max(ts) FROM events))"

# What an append-mode stream has put out at the end of its input: rows the final watermark has passed.
ENDS_OUT = f"{LAST_SLIDE} - {_span(SCALED.moving_delay)}"
PANE_END = f"time_bucket({_span(SCALED.slide)}, {{}}) + {_span(SCALED.slide)}"
CLOSED = f"{LAST} - {_span(SCALED.moving_delay)}"
ZSCORES_OUT = f"least({LAST} - {_span(SCALED.zscore_tick_delay)}, {LAST_SLIDE} - {_span(SCALED.zscore_moving_delay)})"
SHORTEST_OUT = f"{LAST} - {_span(SCALED.shortest_delay)} - {_span(SCALED.horizon)}"


def _firsts_cte() -> str:
    return f"""f AS (
      SELECT l.event_type AS symbol, l.ts AS "timestamp", l.value AS price,
             min(r.ts) FILTER (WHERE r.value > l.value) AS first_higher,
             min(r.ts) FILTER (WHERE r.value < l.value) AS first_lower
      FROM events AS l LEFT JOIN events AS r
        ON l.event_type = r.event_type AND r.ts > l.ts AND r.ts <= l.ts + {_span(SCALED.horizon)}
      GROUP BY l.event_type, l.ts, l.value)"""


def _seconds(side: str) -> str:
    horizon = micros(SCALED.horizon) / 1e6
    return f"""CAST(coalesce(epoch(first_{side}) - epoch("timestamp"), {horizon}) AS FLOAT)"""


def _shortest(columns: str, where: str = "TRUE") -> str:
    return f"WITH {_firsts_cte()} SELECT {columns} FROM f WHERE {where}"


HIGHER_LOWER = f"{_seconds('higher')} AS higher_window, {_seconds('lower')} AS lower_window"


def _positions(prefix: str, source: str, digits: int = 6) -> str:
    return ", ".join(f"{_rounded(f'{source}_{w}', digits)} AS {prefix}_{i}" for i, w in enumerate(SCALED.labels))


def _labelled() -> str:
    return ", ".join(f"'{w}' AS window_{i}" for i, w in enumerate(SCALED.labels))


LABELS = ",".join(SCALED.labels)
FIRST = SCALED.labels[0]
DECODED = f"""SELECT event_type AS symbol, {_rounded("value")} AS price, {MILLIS.format("ts")} AS event_time FROM events"""


def _arrivals() -> str:
    """a: ticks with the wave they arrive in; closed: the watermark each wave finds."""
    return f"""span AS (SELECT epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last FROM events),
      a AS (SELECT ts, event_type, value,
                   (epoch_us(ts) - first) * {WAVES} // (last - first + 1)
                     + CASE WHEN event_id % 10 = 3 THEN 1 ELSE 0 END AS arrival
            FROM events, span),
      closed AS (SELECT w.arrival, max({MILLIS.format("a.ts")}) - {_span(SCALED.moving_delay)} AS watermark
                 FROM (SELECT DISTINCT arrival FROM a) AS w LEFT JOIN a ON a.arrival < w.arrival GROUP BY w.arrival)"""


def _late_data() -> str:
    """Windows per arriving event, without those closed before its wave; then what the last watermark lets out."""
    slide, panes = _span(SCALED.slide), SCALED.panes("5m")
    return f"""WITH {_arrivals()},
      x AS (SELECT event_type AS symbol, value, time_bucket({slide}, ts) + i * {slide} AS "timestamp", watermark
            FROM a JOIN closed USING (arrival), range(1, {panes + 1}) AS r(i))
      SELECT symbol, "timestamp", count(*) AS n, {_rounded("sum(value)")} AS sum_price
      FROM x WHERE (watermark IS NULL OR "timestamp" > watermark) AND "timestamp" <= {CLOSED}
      GROUP BY symbol, "timestamp" """


def _late_moving_stats() -> str:
    """The definition over the ticks whose pane is open when they arrive."""
    open_pane = f"watermark IS NULL OR {PANE_END.format('ts')} > watermark"
    kept = f"kept AS (SELECT * FROM a JOIN closed USING (arrival) WHERE {open_pane})"
    columns = ", ".join(f"{_rounded(f'{k}_{w}')} AS {k}_{w}" for w in SCALED.labels for k in ("avg", "std"))
    return f"""WITH {_arrivals()}, {kept}, {_moving_cte(source="kept")}
      SELECT symbol, "timestamp", {columns} FROM m WHERE "timestamp" <= {CLOSED}"""


def _late_dropped() -> str:
    """Per wave the distinct (symbol, pane) that its ticks fall into or mark and that were closed before."""
    slide, shortest = _span(SCALED.slide), SCALED.panes(FIRST)
    return f"""WITH {_arrivals()},
      x AS (SELECT arrival, event_type, time_bucket({slide}, ts) + i * {slide} AS pane_end, watermark
            FROM a JOIN closed USING (arrival), range(1, {shortest + 1}) AS r(i))
      SELECT arrival, count(DISTINCT (event_type, pane_end)) FILTER (WHERE pane_end <= watermark) AS dropped
      FROM x GROUP BY arrival"""


ORACLES: dict[str, str] = {
    "moving_stats": _moving(),
    "moving_stats_reference": _moving(REFERENCE),
    "moving_stats_join": _moving(),
    **{f"moving_avg_std_{w}": _moving_single(w) for w in SCALED.labels},
    **{f"moving_avg_std_reference_{w}": _moving_single(w, REFERENCE) for w in SHORT_WINDOWS},
    "moving_stats_array": f"""WITH {_moving_cte()} SELECT "timestamp", symbol, '{LABELS}' AS labels,
        {_positions("avg", "avg")}, {_positions("std", "std")} FROM m""",
    "moving_by_window": _moving_rows(),
    "zscore": f"""WITH {_zscore_cte()} SELECT "timestamp", symbol, '{LABELS}' AS labels,
        {_positions("zscore", "z", 4)} FROM z""",
    "zscore_by_window": _zscore_rows(),
    "flag_outliers": _zscore_rows(more=f", abs(zscore) > {OUTLIER_THRESHOLD} AS is_outlier"),
    "forward_pairs": f"""SELECT l.event_type AS symbol, {_rounded("l.value")} AS price, l.ts AS event_time,
        {_rounded("r.value")} AS right_price, r.ts AS right_time
      FROM events AS l LEFT JOIN events AS r
        ON l.event_type = r.event_type AND r.ts > l.ts AND r.ts <= l.ts + {_span(SCALED.horizon)}""",
    "shortest_windows": _shortest(f'"timestamp", symbol, {HIGHER_LOWER}'),
    "shortest_windows_found": _shortest(
        f"""\"timestamp", symbol, {HIGHER_LOWER}, first_higher IS NOT NULL AS higher_found,
        first_lower IS NOT NULL AS lower_found"""
    ),
    "shortest_higher": _shortest(f"\"timestamp\", {_seconds('higher')} AS higher_window"),
    "shortest_lower": _shortest(f"\"timestamp\", {_seconds('lower')} AS lower_window"),
    "normalize_ticks": f"""SELECT event_type AS symbol,
        CASE WHEN event_id % 9 <> 4 THEN {_rounded("value")} END AS price,
        time_bucket({_span(REFERENCE.slot)}, ts) AS event_time FROM events""",
    "conflate_latest": f"""SELECT event_type AS symbol, time_bucket({_span(SCALED.slot)}, ts) AS slot,
        {_rounded("arg_max(value, ts)")} AS price FROM events WHERE event_id % 11 <> 3 GROUP BY 1, 2""",
    "locf_resample": f"""WITH c AS (
        SELECT event_type AS symbol, time_bucket({_span(SCALED.slide)}, ts) AS slot, arg_max(value, ts) AS price
        FROM events WHERE event_id % 11 <> 3 GROUP BY 1, 2),
      g AS (SELECT symbol, unnest(generate_series(min(slot), max(slot), {_span(SCALED.slide)})) AS slot
            FROM c GROUP BY symbol)
      SELECT g.symbol, g.slot, {_rounded("c.price")} AS price
      FROM g ASOF JOIN c ON g.symbol = c.symbol AND g.slot >= c.slot""",
    "valid_ticks": f"""SELECT event_id, event_type AS symbol, {_rounded("value")} AS price, ts AS event_time
      FROM events WHERE event_id % 11 <> 3 AND event_id % 13 <> 5""",
    "fill_placeholder_ticks": f"""SELECT event_id, event_type AS symbol,
        CASE WHEN event_id % 11 = 3 THEN 0.0 ELSE {_rounded("value")} END AS price, ts AS event_time FROM events""",
    "drop_placeholder_ticks": f"""SELECT event_id, event_type AS symbol, {_rounded("value")} AS price,
        ts AS event_time FROM events WHERE event_id % 17 <> 0 AND value > 0""",
    "encode_ticks_json": f"""SELECT '{{"symbol":"' || event_type || '","price":' || CAST(value AS VARCHAR)
        || ',"event_time":"' || {ISO.format("ts")} || '"}}' AS value FROM events""",
    "encode_moving_json": f"""WITH {_moving_cte()} SELECT {ISO.format('"timestamp"')} AS "timestamp", symbol,
        {_labelled()}, {_positions("avg_price", "avg")}, {_positions("std_price", "std")} FROM m""",
    "encode_zscores_json": f"""WITH {_zscore_cte()} SELECT {ISO.format('"timestamp"')} AS "timestamp", symbol,
        {_labelled()}, {_positions("zscore_price", "z", 4)} FROM z""",
    "decode_ticks": DECODED,
    "decode_malformed": f"""SELECT event_id,
        CASE WHEN event_id % 7 NOT IN (0, 4) THEN event_type END AS symbol,
        CASE WHEN event_id % 7 NOT IN (0, 1, 4) THEN {_rounded("value")} END AS price,
        CASE WHEN event_id % 7 NOT IN (0, 2, 4) THEN {MILLIS.format("ts")} END AS event_time FROM events""",
    "decode_moving": _moving_rows(),
    "decode_zscores": _zscore_rows(time=MILLIS.format('"timestamp"')),
    "replay_ticks": DECODED,
    "load_zscores": _zscore_rows(time=MILLIS.format('"timestamp"')),
    "readback_limit": f"""WITH {_moving_cte()} SELECT "timestamp", symbol, {_rounded("avg_1m")} AS avg_price,
        {_rounded("std_1m")} AS std_price FROM m ORDER BY "timestamp", symbol LIMIT 5""",
    "readback_count": f"WITH {_moving_cte()} SELECT count(*) AS n FROM m",
    "stream_ticks_passthrough": DECODED,
    "stream_moving_stats": _moving(where=f'"timestamp" <= {CLOSED}'),
    "stream_window_ends": _moving(where=f'"timestamp" <= {ENDS_OUT}'),
    "stream_moving_stats_join": _moving(where=f'"timestamp" <= {ENDS_OUT}'),
    "stream_zscore": _zscore_rows(
        where=f"""{PANE_END.format('"timestamp"')} <= {LAST} - {_span(SCALED.zscore_tick_delay)}"""
    ),
    "stream_zscore_join": _zscore_rows(where=f"window_end <= {ZSCORES_OUT}"),
    "stream_zscore_chained": _zscore_rows(where=f"window_end <= {CLOSED}"),
    "stream_shortest_windows": _shortest(
        f'"timestamp", symbol, {HIGHER_LOWER}', where=f'"timestamp" <= {SHORTEST_OUT}'
    ),
    "stream_shortest_pairs": _shortest(
        f'"timestamp", symbol, {HIGHER_LOWER}', where=f'"timestamp" < {SHORTEST_OUT}'
    ),
    "stream_shortest_sinks": " UNION ALL ".join(
        f"""SELECT * FROM ({_shortest(
            f'''{chr(39)}{side}{chr(39)} AS side, {MILLIS.format('"timestamp"')} AS "timestamp",
            {_seconds(side)} AS seconds''', where=f'"timestamp" <= {SHORTEST_OUT}')}) AS s_{side}"""
        for side in ("higher", "lower")
    ),
    "stream_late_data": _late_data(),
    "stream_late_moving_stats": _late_moving_stats(),
    "stream_late_dropped": _late_dropped(),
}
