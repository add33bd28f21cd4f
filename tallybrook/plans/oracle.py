"""The catalog's queries as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

EDITS = """
e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
edits AS (
  SELECT ts AS ingested_at,
         ts - to_minutes(CAST((event_id * 7919) % 13 AS INT)) AS event_time,
         'w' || lpad(CAST(k % 20 AS VARCHAR), 2, '0') AS wiki,
         CASE WHEN event_type = 'signup' THEN 'new' ELSE event_type END AS type,
         CASE WHEN user_id % 10 <> 0 THEN 'u' || user_id END AS "user",
         event_id AS id,
         user_id % 3 = 0 AS bot,
         CAST(k % 20 % 6 AS INT) AS kafka_partition,
         event_id AS kafka_offset,
         epoch_us(ts) // 600000000 AS poll
  FROM e
)"""

COPIES = EDITS + """,
copies AS (
  SELECT * REPLACE (ingested_at + to_seconds(c) AS ingested_at)
  FROM edits, unnest(CASE WHEN type = 'error' THEN [0, 1] ELSE [0] END) AS u(c)
)"""

MESSAGES = """
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
         CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS clock
  FROM events
),
f AS (
  SELECT event_id, ts, k,
         CASE WHEN k = 12 THEN 'null' ELSE CAST(event_id AS VARCHAR) END AS id_,
         CASE WHEN k = 4 THEN 'null' WHEN k = 12 THEN '"log"' WHEN k = 14 THEN '7' WHEN k = 15 THEN 'true'
              WHEN event_type = 'signup' THEN '"new"' ELSE '"' || event_type || '"' END AS type_,
         CASE WHEN k = 3 THEN '""' WHEN k = 5 THEN '7'
              ELSE '"w' || lpad(CAST(k % 20 AS VARCHAR), 2, '0') || '"' END AS wiki_,
         CASE WHEN user_id % 10 = 0 THEN 'null' ELSE '"u' || user_id || '"' END AS user_,
         CASE WHEN k = 6 THEN clock || '.5' WHEN k = 7 THEN '"2024-06-18"' ELSE clock END AS clock_,
         CASE WHEN k = 8 THEN '"false"' WHEN k = 9 THEN '0' WHEN k = 10 THEN '1' WHEN k = 11 THEN 'null'
              WHEN user_id % 3 = 0 THEN 'true' ELSE 'false' END AS bot_
  FROM e
),
messages AS (
  SELECT 'changes' AS topic, CAST(k % 20 % 6 AS INT) AS partition, event_id AS "offset", ts AS "timestamp",
         CASE WHEN k = 0 THEN '{bad' WHEN k = 1 THEN '[]' WHEN k = 2 THEN '   ' WHEN k = 13 THEN '42'
              ELSE '{"id":' || id_ || ',"type":' || type_ || ',"title":null,"wiki":' || wiki_
                   || ',"user":' || user_ || ',"timestamp":' || clock_ || ',"bot":' || bot_
                   || ',"comment":"dropped"}' END AS value
  FROM f
),
j AS MATERIALIZED (
  SELECT *, CASE WHEN json_valid(value) THEN value ELSE 'null' END AS doc, json_valid(value) AS valid
  FROM messages WHERE trim(value) <> ''
),
fields AS (
  SELECT *,
         CASE WHEN json_type(doc, '$.type') IN ('VARCHAR', 'BIGINT', 'UBIGINT', 'BOOLEAN')
              THEN nullif(json_extract_string(doc, '$.type'), '') END AS f_type,
         CASE WHEN json_type(doc, '$.wiki') = 'VARCHAR' THEN nullif(json_extract_string(doc, '$.wiki'), '') END AS f_wiki,
         CAST(json_extract_string(doc, '$.id') AS BIGINT) AS f_id,
         json_extract_string(doc, '$.user') AS f_user,
         CASE WHEN json_type(doc, '$.timestamp') IN ('BIGINT', 'UBIGINT', 'DOUBLE')
              THEN CAST(floor(CAST(json_extract_string(doc, '$.timestamp') AS DOUBLE)) AS BIGINT) END AS f_timestamp,
         CASE json_type(doc, '$.bot')
              WHEN 'BOOLEAN' THEN json_extract_string(doc, '$.bot') = 'true'
              WHEN 'VARCHAR' THEN json_extract_string(doc, '$.bot') <> ''
              WHEN 'BIGINT' THEN json_extract_string(doc, '$.bot') <> '0'
              WHEN 'UBIGINT' THEN json_extract_string(doc, '$.bot') <> '0'
              ELSE false END AS f_bot
  FROM j
),
judged AS (
  SELECT *, CASE WHEN NOT valid THEN 'unparseable'
                 WHEN json_type(doc) <> 'OBJECT' OR f_type IS NULL OR f_wiki IS NULL THEN 'invalid'
                 ELSE '' END AS error
  FROM fields
),
clean AS (
  SELECT "timestamp" AS ingested_at, make_timestamp(f_timestamp * 1000000) AS event_time, f_wiki AS wiki,
         f_type AS type, CAST(NULL AS VARCHAR) AS title, f_user AS "user", f_id AS id, f_bot AS bot,
         partition AS kafka_partition, "offset" AS kafka_offset
  FROM judged WHERE error = ''
),
dead AS (
  SELECT topic, partition AS kafka_partition, "offset" AS kafka_offset, "timestamp" AS seen, error, value AS raw_message
  FROM judged WHERE error <> ''
)"""

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
NOW_S = "1706659200"


def epoch(ts: str) -> str:
    return f"epoch_us({ts}) // 1000000"


def floor_to(ts: str, size: int) -> str:
    return f"(epoch_us({ts}) // {size * 1_000_000} * {size})"


def minute_rollup(source: str) -> str:
    return f"""
  SELECT date_trunc('minute', ingested_at) AS minute, wiki, count(*) AS edits,
         count(*) FILTER (WHERE bot) AS bot_edits, count(*) FILTER (WHERE type = 'new') AS new_pages
  FROM {source} GROUP BY 1, 2"""


def timeline(range_seconds: int, step: int) -> str:
    if step == 86_400:
        keep = f"CAST(ingested_at AS DATE) >= CAST({NOW} - INTERVAL {range_seconds} SECOND AS DATE)"
    else:
        keep = f"date_trunc('minute', ingested_at) >= {NOW} - INTERVAL {range_seconds} SECOND"
    return f"""
  SELECT {floor_to('ingested_at', step)} AS t, count(*) AS edits, count(*) FILTER (WHERE bot) AS bot_edits,
         count(*) FILTER (WHERE type = 'new') AS new_pages, count(DISTINCT "user") AS editors
  FROM edits WHERE {keep} GROUP BY 1"""


def grid(range_seconds: int, step: int) -> str:
    return (
        f"SELECT unnest(range(({NOW_S} - {range_seconds}) // {step} * {step},"
        f" {NOW_S} // {step} * {step} + {step}, {step})) AS t"
    )


def shown(x: str) -> str:
    """To one place, by the exact value of the double; exact halves go up."""
    return f"CASE WHEN {x} * 4 = floor({x} * 4) THEN floor({x} * 10 + 0.5) / 10 ELSE CAST(printf('%.1f', {x}) AS DOUBLE) END"


def with_edits(body: str) -> str:
    return f"WITH {EDITS}\n{body}"


def with_messages(body: str) -> str:
    return f"WITH {MESSAGES}\n{body}"


def slices(size: int) -> str:
    """Long-form counts per (window, partition), one row per slice with its texts."""
    return f""",
w AS (
  SELECT {floor_to('ingested_at', size)} AS window_start, kafka_partition AS partition, wiki, type,
         coalesce(nullif("user", ''), 'anonymous') AS usr, bot
  FROM edits
),
by_wiki AS (SELECT window_start, partition, wiki, count(*) AS n FROM w GROUP BY ALL),
by_type AS (SELECT window_start, partition, type, count(*) AS n FROM w GROUP BY ALL),
by_user AS (
  SELECT window_start, partition, usr, count(*) AS n FROM w GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY window_start, partition ORDER BY n DESC, usr) <= 5
),
totals AS (
  SELECT window_start, partition, count(*) AS total, count(*) FILTER (WHERE bot) AS bots FROM w GROUP BY ALL
)"""


def texts(size: int, keys: str, wikis: str, types: str, users: str, totals: str, extra: str) -> str:
    on = f"USING ({keys})"
    return f"""
SELECT window_start, window_start + {size} AS window_end, total AS total_edits,
       round(total / {size}, 2) AS edits_per_second, edits_per_wiki, bots AS bot, total - bots AS human,
       edit_types, top_editors, {extra}
FROM {totals}
JOIN (SELECT {keys}, string_agg(wiki || '=' || n, ',' ORDER BY n DESC, wiki) AS edits_per_wiki FROM {wikis} GROUP BY ALL) {on}
JOIN (SELECT {keys}, string_agg(type || '=' || n, ',' ORDER BY n DESC, type) AS edit_types FROM {types} GROUP BY ALL) {on}
JOIN (SELECT {keys}, string_agg(usr || '=' || n, ',' ORDER BY n DESC, usr) AS top_editors FROM {users} GROUP BY ALL) {on}"""


MERGED = """,
m_wiki AS (SELECT window_start, wiki, CAST(sum(n) AS BIGINT) AS n FROM by_wiki GROUP BY ALL),
m_type AS (SELECT window_start, type, CAST(sum(n) AS BIGINT) AS n FROM by_type GROUP BY ALL),
m_user AS (
  SELECT window_start, usr, count(*) AS n FROM w GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY count(*) DESC, usr) <= 5
),
m_total AS (
  SELECT window_start, CAST(sum(total) AS BIGINT) AS total, CAST(sum(bots) AS BIGINT) AS bots,
         CAST(count(*) AS INT) AS partitions
  FROM totals GROUP BY ALL
)"""


def merged(size: int, where: str = "") -> str:
    return slices(size) + MERGED + texts(
        size, "window_start", "m_wiki", "m_type", "m_user", f"(FROM m_total {where})", "partitions"
    )


# Slices by the payload's clock, written when the last of their edits came in.
SLICE_DELAYS = """,
delays AS (
  SELECT window_start, partition, epoch_us(written_at) / 1000000.0 - (window_start + 300) AS delay_seconds
  FROM (
    SELECT epoch_us(event_time) // 300000000 * 300 AS window_start, kafka_partition AS partition, max(ingested_at) AS written_at
    FROM edits GROUP BY 1, 2
  )
)"""

SCHEDULE = """,
c AS (
  SELECT *, epoch_us(event_time) AS us, epoch_us(event_time) // 300000000 * 300 AS window_start FROM edits
),
polls AS (
  SELECT kafka_partition, poll, max(us) AS poll_us, arg_min(window_start, kafka_offset) AS first_window
  FROM c GROUP BY ALL
),
marks AS (
  SELECT kafka_partition, poll,
         first_value(first_window) OVER so_far - 300 AS origin,
         max(poll_us) OVER so_far AS mark
  FROM polls
  WINDOW so_far AS (PARTITION BY kafka_partition ORDER BY poll ROWS UNBOUNDED PRECEDING)
),
reach AS (
  SELECT *, greatest(origin, (mark - 60000000) // 300000000 * 300 - 300) AS through FROM marks
),
schedule AS (
  SELECT *, coalesce(lag(through) OVER (PARTITION BY kafka_partition ORDER BY poll), origin) AS before FROM reach
),
routed AS (
  SELECT c.*, c.window_start <= s.before AS late
  FROM c JOIN schedule s USING (kafka_partition, poll)
),
taken AS (
  SELECT kafka_partition, window_start, count(*) AS events FROM routed WHERE NOT late GROUP BY ALL
),
ends AS (SELECT kafka_partition, max(through) AS final FROM schedule GROUP BY ALL)"""


def emitted(cap: int | None) -> str:
    first = "before + 300" if cap is None else f"greatest(before + 300, through - {(cap - 1) * 300})"
    return SCHEDULE + f""",
out AS (
  SELECT kafka_partition, poll AS emitted_by, unnest(range({first}, through + 300, 300)) AS window_start
  FROM schedule WHERE through > before
),
fate AS (
  SELECT kafka_partition, window_start, coalesce(events, 0) AS events, emitted_by,
         CASE WHEN emitted_by IS NOT NULL THEN 'emitted' WHEN window_start <= final THEN 'dropped'
              ELSE 'open' END AS status
  FROM out FULL JOIN taken USING (kafka_partition, window_start) JOIN ends USING (kafka_partition)
)"""


DELAYS = emitted(None) + """,
delays AS (
  SELECT kafka_partition, window_start, (emitted_by + 1) * 600 AS written_at,
         CAST((emitted_by + 1) * 600 - (window_start + 300) AS DOUBLE) AS delay_seconds
  FROM fate WHERE status = 'emitted'
)"""

BUCKETS = DELAYS + """,
bounds AS (SELECT unnest([60, 300, 600, 1200, 1800, 3600, 7200, 14400, CAST('inf' AS DOUBLE)]) AS le),
buckets AS (
  SELECT kafka_partition, le, count(*) FILTER (WHERE delay_seconds <= le) AS cumulative
  FROM delays CROSS JOIN bounds GROUP BY ALL
)"""

CLOSES = """,
c AS (SELECT *, (epoch_us(event_time) // 300000000 * 300 + 360) * 1000000 AS closes, epoch_us(event_time) AS us FROM edits),
r AS (
  SELECT *, max(us) OVER (PARTITION BY kafka_partition) AS mark,
         max(us) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM c
)"""

LATENESS = "60, 180, 300, 420, 540, 660, CAST('inf' AS DOUBLE)"

# One row per partition and scrape, counters as running sums that start anew once.
SAMPLES = f""",
late AS (
  SELECT *, epoch_us(ingested_at) // 300000000 * 300 + 300 AS ts,
         (epoch_us(ingested_at) // 1000000) - (epoch_us(event_time) // 1000000) AS delay
  FROM edits
),
scrapes AS (
  SELECT kafka_partition, ts, ts > 1705276800 AS run, max(event_time) AS newest, max(kafka_offset) AS newest_offset, 1 AS windows,
         count(*) AS consumed, count(*) FILTER (WHERE type = 'error') AS failed,
         count(*) FILTER (WHERE type = 'error' AND bot) AS failed_bots, count(*) FILTER (WHERE type = 'click') AS dropped,
         list_transform([{LATENESS}], lambda b: len(list_filter(list(delay), lambda d: d <= b))) AS within
  FROM late GROUP BY ALL
),
counted AS (
  SELECT CAST(kafka_partition AS VARCHAR) AS partition, ts, CAST(ts - epoch_us(newest) // 1000000 AS DOUBLE) AS lag,
         newest_offset % 5000 AS uncommitted, CASE WHEN 2 * failed >= consumed THEN 0 ELSE 1 END AS up,
         sum(windows) OVER o AS windows, sum(consumed) OVER o AS total, sum(failed) OVER o AS failed,
         sum(failed_bots) OVER o AS failed_bots, sum(dropped) OVER o AS dropped,
         {", ".join(f"sum(within[{k + 1}]) OVER o AS le{k}" for k in range(7))}
  FROM scrapes WINDOW o AS (PARTITION BY kafka_partition, run ORDER BY ts)
),
grown AS (
  SELECT partition, ts, total - lag(total) OVER (PARTITION BY partition ORDER BY ts) AS diff, total FROM counted
),
deltas AS (
  SELECT partition, ts, CAST(CASE WHEN diff < 0 THEN total ELSE diff END AS DOUBLE) AS delta
  FROM grown WHERE diff IS NOT NULL
)"""

# (alert, severity, metric, reading, window, labels, quantile, holds, held for, absent) of each rule, its times 60 times as long.
RULES = (
    ("TargetDown", "critical", "up", "value", 18_000, "'partition=' || partition", "NULL", "value = 0", 3_600, False),
    ("PipelineStalled", "critical", "windows", "rate", 3_600, "''", "NULL", "value = 0", 7_200, True),
    ("NoEventsProduced", "critical", "produced", "rate", 3_600, "''", "NULL", "value = 0", 7_200, True),
    ("ConsumerLagHigh", "warning", "uncommitted", "value", 18_000, "''", "NULL", "value > 2000", 7_200, False),
    ("FreshnessSLOBreached", "warning", "within", "rate", 18_000, "''", "0.99", "value > 2.5", 18_000, False),
    ("ProduceErrors", "critical", "failed", "increase", 18_000, "'partition=' || partition", "NULL", "value > 0", 0, False),
    ("SinkErrors", "warning", "failed_bots", "increase", 18_000, "'partition=' || partition", "NULL", "value > 0", 0, False),
    ("EventsDropped", "warning", "dropped", "rate", 18_000, "''", "NULL", "value > 1", 36_000, False),
)
GRID = "SELECT unnest(range(1703980800, 1706659201, 1800)) AS t"


def values(readers: str) -> str:
    """``readers(name, metric, reading, win, q)`` and ``heads(name, partition, labels)`` at each step of the grid."""
    return SAMPLES + f""",
long AS (
  SELECT partition, ts, unnest([
    {{'metric': 'up', 'le': NULL::DOUBLE, 'v': up::DOUBLE}}, {{'metric': 'windows', 'le': NULL, 'v': windows}},
    {{'metric': 'produced', 'le': NULL, 'v': total - failed}}, {{'metric': 'uncommitted', 'le': NULL, 'v': uncommitted}},
    {{'metric': 'failed', 'le': NULL, 'v': failed}}, {{'metric': 'failed_bots', 'le': NULL, 'v': failed_bots}},
    {{'metric': 'dropped', 'le': NULL, 'v': dropped}},
    {", ".join(f"{{'metric': 'within', 'le': {le}, 'v': le{k}}}" for k, le in enumerate(LATENESS.split(", ")))}], recursive := true)
  FROM counted
),
paired AS (
  SELECT *, lag(ts) OVER s AS last_ts, v - lag(v) OVER s AS diff FROM long WINDOW s AS (PARTITION BY partition, metric, le ORDER BY ts)
),
grid AS ({GRID}),
readers AS ({readers}),
heads AS (SELECT DISTINCT partition FROM counted),
read AS (
  SELECT name, reading, win, q, labels, p.partition, le, t,
         CASE WHEN reading = 'value' THEN arg_max(v, ts) ELSE sum(CASE WHEN diff < 0 THEN v ELSE diff END) END AS own
  FROM readers JOIN paired p USING (metric, partition)
  JOIN grid ON t >= ts AND t < win + CASE WHEN reading = 'value' THEN ts ELSE last_ts END
  GROUP BY name, reading, win, q, labels, p.partition, le, t
),
summed AS (SELECT name, reading, win, q, labels, le, t, sum(own) AS own FROM read GROUP BY ALL),
ranks AS (
  SELECT *, lag(le, 1, 0) OVER o AS low, lag(own, 1, 0) OVER o AS below, q * max(own) OVER (PARTITION BY name, labels, t) AS rank_
  FROM summed WINDOW o AS (PARTITION BY name, labels, t ORDER BY le)
),
told AS (
  SELECT name, labels, t, own / CASE WHEN reading = 'rate' THEN CAST(win AS DOUBLE) ELSE 1 END AS value FROM summed WHERE q IS NULL
  UNION ALL
  SELECT name, labels, t, arg_min(CASE WHEN isinf(le) OR own = below THEN low ELSE low + (le - low) * (rank_ - below) / (own - below) END, le)
  FROM ranks WHERE q IS NOT NULL AND own >= rank_ AND own > 0 GROUP BY ALL
)"""


def rule_readers() -> str:
    rows = [f"SELECT '{alert}' AS name, '{metric}' AS metric, '{reading}' AS reading, {window} AS win, {q}::DOUBLE AS q, "
            f"partition, {labels} AS labels FROM (SELECT DISTINCT partition FROM counted)"
            for alert, _, metric, reading, window, labels, q, _, _, _ in RULES]
    return " UNION ALL ".join(rows)


def rule_states() -> str:
    each = []
    for alert, severity, metric, _, _, _, _, holds, held, absent in RULES:
        active = f"coalesce({holds}, false)"
        if absent:
            active += f" OR t NOT IN (SELECT t FROM grid JOIN long ON metric = '{metric}' AND t >= ts AND t < ts + 18000)"
        source = f"(SELECT t, '' AS labels, value FROM grid LEFT JOIN (FROM told WHERE name = '{alert}') USING (t))" if absent else (
            f"(SELECT t, labels, value FROM told WHERE name = '{alert}')")
        each.append(f"""SELECT alert, severity, labels, t, value, CASE WHEN NOT active THEN 'inactive'
    WHEN count(*) FILTER (WHERE active) OVER (PARTITION BY labels ORDER BY t RANGE BETWEEN {held} PRECEDING AND CURRENT ROW) > {held // 1800}
    THEN 'firing' ELSE 'pending' END AS state
  FROM (SELECT '{alert}' AS alert, '{severity}' AS severity, labels, t, value, {active} AS active FROM {source})
  WHERE value IS NOT NULL OR active""")
    return " UNION ALL ".join(each)


def gauge(fn: str, key: str, window: int) -> str:
    return f"""
SELECT 'watermark_lag_seconds' AS metric, label, t, {fn}(value) AS value
FROM (
  SELECT partition, {key} AS label, ts // {window} * {window} AS t, arg_max(lag, ts) AS value
  FROM counted GROUP BY ALL
) GROUP BY ALL"""


ORACLES: dict[str, str] = {
    # ingest
    "events_project": with_messages("""
SELECT "offset", f_id AS id, f_type AS type, CAST(NULL AS VARCHAR) AS title, f_wiki AS wiki, f_user AS "user",
       f_timestamp AS "timestamp", f_bot AS bot
FROM judged WHERE error = ''"""),
    "events_dropped_by_reason": with_messages(
        "SELECT error AS reason, count(*) AS dropped FROM judged WHERE error <> '' GROUP BY 1"),
    "events_parse": with_messages("""
SELECT partition, "offset", error, CASE WHEN error = '' THEN f_id END AS id, CASE WHEN error = '' THEN f_type END AS type,
       CAST(NULL AS VARCHAR) AS title, CASE WHEN error = '' THEN f_wiki END AS wiki, CASE WHEN error = '' THEN f_user END AS "user",
       CASE WHEN error = '' THEN f_timestamp END AS "timestamp", CASE WHEN error = '' THEN f_bot END AS bot
FROM judged"""),
    "events_clean": with_messages("SELECT * FROM clean"),
    "events_dead_letter": with_messages(f"""
SELECT {NOW} AS seen_at, topic, kafka_partition, kafka_offset, error, raw_message FROM dead"""),
    "events_publish": with_messages("""
SELECT f_wiki AS "key", CAST(to_json(struct_pack(
         id := f_id, type := f_type, title := CAST(NULL AS VARCHAR), wiki := f_wiki, "user" := f_user,
         "timestamp" := f_timestamp, bot := f_bot)) AS VARCHAR) AS value
FROM judged WHERE error = ''"""),
    "edits_dedup": f"""WITH {COPIES}
SELECT min(ingested_at) AS ingested_at, wiki, type, "user", bot, kafka_partition, kafka_offset
FROM copies GROUP BY ALL""",
    "retention_cutoff": f"""WITH {EDITS}, {MESSAGES.replace('e AS (', 'e2 AS (', 1).replace('FROM e' + chr(10), 'FROM e2' + chr(10), 1)}, r AS ({minute_rollup('edits')}),
rows_ AS (
  SELECT 'edits' AS table_name, ingested_at + INTERVAL 7 DAY <= {NOW} AS gone FROM edits
  UNION ALL SELECT 'edits_errors', seen + INTERVAL 30 DAY <= {NOW} FROM dead
  UNION ALL SELECT 'edits_1m', minute + INTERVAL 90 DAY <= {NOW} FROM r
  UNION ALL SELECT 'edits_1d', false FROM (SELECT DISTINCT CAST(minute AS DATE), wiki FROM r)
)
SELECT table_name, count(*) FILTER (WHERE NOT gone) AS kept, count(*) FILTER (WHERE gone) AS dropped
FROM rows_ GROUP BY 1""",
    # filters and placeholders
    "range_filter": with_edits(f"""
SELECT kafka_partition, kafka_offset, ingested_at, wiki FROM edits WHERE ingested_at >= {NOW} - INTERVAL 7 DAY"""),
    "recent_partitions": with_edits(f"""
SELECT kafka_partition, kafka_offset, ingested_at FROM edits
WHERE CAST(ingested_at AS DATE) >= CAST({NOW} AS DATE) - 1"""),
    "edits_normalized": with_edits("""
SELECT kafka_offset, coalesce(nullif(wiki, ''), 'unknown') AS wiki, coalesce(nullif(type, ''), 'unknown') AS type,
       coalesce(nullif("user", ''), 'anonymous') AS "user", coalesce(bot, false) AS bot
FROM edits"""),
    "event_clock": with_messages("""
SELECT kafka_offset, CASE WHEN epoch_us(event_time) > 0 THEN event_time ELSE ingested_at END AS clock FROM clean"""),
    "window_assign": with_edits(f"""
SELECT kafka_offset, {floor_to('event_time', 5)} AS window_start, {floor_to('event_time', 5)} + 5 AS window_end
FROM edits"""),
    # rollups
    "rollup_1m": with_edits("""
SELECT date_trunc('minute', ingested_at) AS minute, wiki, count(*) AS edits, count(*) FILTER (WHERE bot) AS bot_edits,
       count(*) FILTER (WHERE type = 'new') AS new_pages, count(DISTINCT "user") AS editors
FROM edits GROUP BY 1, 2"""),
    "rollup_1d": with_edits("""
SELECT CAST(ingested_at AS DATE) AS day, wiki, count(*) AS edits, count(*) FILTER (WHERE bot) AS bot_edits,
       count(*) FILTER (WHERE type = 'new') AS new_pages, count(DISTINCT "user") AS editors
FROM edits GROUP BY 1, 2"""),
    "rollup_redelivered": f"""WITH {COPIES}
SELECT CAST(ingested_at AS DATE) AS day, wiki, count(*) AS edits, count(*) FILTER (WHERE bot) AS bot_edits,
       count(*) FILTER (WHERE type = 'new') AS new_pages, count(DISTINCT "user") AS editors
FROM copies GROUP BY 1, 2""",
    "editors_distinct": with_edits('SELECT wiki, count(DISTINCT "user") AS editors FROM edits GROUP BY 1'),
    # analytics
    "timeline_1m": with_edits(timeline(86_400, 60)),
    "timeline_5m": with_edits(timeline(86_400, 300)),
    "timeline_1h": with_edits(timeline(604_800, 3_600)),
    "timeline_1d": with_edits(timeline(2_592_000, 86_400)),
    "timeline_grid": with_edits(f""", p AS ({timeline(86_400, 300)})
SELECT g.t, edits, bot_edits, new_pages, editors FROM ({grid(86_400, 300)}) g LEFT JOIN p USING (t)"""),
    "timeline_rates": with_edits(f""", p AS ({timeline(604_800, 3_600)})
SELECT g.t, CAST(edits AS DOUBLE) / 60 AS edits_per_minute, CAST(bot_edits AS DOUBLE) / 60 AS bot_edits_per_minute
FROM ({grid(604_800, 3_600)}) g LEFT JOIN p USING (t)"""),
    "timeline_rates_shown": with_edits(f""", p AS ({timeline(604_800, 3_600)}),
r AS (
  SELECT g.t, CAST(edits AS DOUBLE) / 60 AS edits_per_minute, CAST(bot_edits AS DOUBLE) / 60 AS bot_edits_per_minute
  FROM ({grid(604_800, 3_600)}) g LEFT JOIN p USING (t)
)
SELECT t, {shown("edits_per_minute")} AS edits_per_minute, {shown("bot_edits_per_minute")} AS bot_edits_per_minute FROM r"""),
    "rollup_1d_exact": with_edits("""
SELECT CAST(ingested_at AS DATE) AS day, wiki, count(DISTINCT "user") AS editors FROM edits GROUP BY 1, 2 HAVING editors > 0"""),
    "stored_editors": with_messages('SELECT wiki, count(DISTINCT "user") AS editors FROM clean GROUP BY 1 HAVING editors > 0'),
    "stored_editors_7d": with_messages(f"""
SELECT wiki, count(DISTINCT "user") AS editors FROM clean
WHERE CAST(ingested_at AS DATE) >= CAST({NOW} - INTERVAL 7 DAY AS DATE) GROUP BY 1 HAVING editors > 0"""),
    "top_wikis": with_edits(f"""
SELECT wiki, count(*) AS edits, count(*) FILTER (WHERE bot) AS bot_edits, count(DISTINCT "user") AS editors
FROM edits WHERE date_trunc('minute', ingested_at) >= {NOW} - INTERVAL 30 DAY
GROUP BY 1 ORDER BY edits DESC, wiki LIMIT 10"""),
    "top_editors": f"""WITH {COPIES}
SELECT "user", count(DISTINCT (kafka_partition, kafka_offset)) AS edits,
       count(DISTINCT (kafka_partition, kafka_offset)) FILTER (WHERE bot) AS bot_edits,
       count(DISTINCT wiki) AS wikis
FROM copies WHERE ingested_at >= {NOW} - INTERVAL 7 DAY AND "user" IS NOT NULL
GROUP BY 1 ORDER BY edits DESC, "user" LIMIT 10""",
    "freshness": with_edits(f"""
SELECT (epoch_us({NOW}) // 1000 - epoch_us(max(ingested_at)) // 1000) / 1000.0 AS age_seconds
FROM edits WHERE CAST(ingested_at AS DATE) >= CAST({NOW} AS DATE) - 1"""),
    "range_tiles": with_edits(f""", p AS (
  SELECT * FROM edits WHERE date_trunc('minute', ingested_at) >= {NOW} - INTERVAL 7 DAY
),
w AS (SELECT wiki, count(*) AS n FROM p GROUP BY 1 ORDER BY n DESC, wiki LIMIT 1)
SELECT count(*) AS total, count(*) FILTER (WHERE bot) * 100.0 / count(*) AS bot_percent,
       count(*) FILTER (WHERE type = 'new') AS new_pages,
       (SELECT wiki FROM w) AS busiest_wiki, (SELECT n FROM w) AS busiest_wiki_edits
FROM p"""),
    "history_tiles": with_edits(f""",
ranges(name, secs, daily) AS (
  VALUES ('1h', 3600, false), ('6h', 21600, false), ('24h', 86400, false), ('7d', 604800, false),
         ('30d', 2592000, true), ('90d', 7776000, true)
),
m AS (
  SELECT r.name, x.*,
         date_trunc('minute', ingested_at) >= {NOW} - to_seconds(secs) AS exact,
         CASE WHEN daily THEN CAST(ingested_at AS DATE) >= CAST({NOW} - to_seconds(secs) AS DATE)
              ELSE date_trunc('minute', ingested_at) >= {NOW} - to_seconds(secs) END AS charted
  FROM edits x CROSS JOIN ranges r
),
t AS (
  SELECT name, count(*) FILTER (WHERE charted) AS total, count(*) FILTER (WHERE charted AND bot) AS bots,
         count(*) FILTER (WHERE charted AND type = 'new') AS new_pages
  FROM m GROUP BY 1
),
w AS (
  SELECT name, wiki, count(*) AS n FROM m WHERE exact GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY n DESC, wiki) = 1
)
SELECT t.name AS "range", total, CASE WHEN total > 0 THEN bots * 100.0 / total END AS bot_percent, new_pages,
       w.wiki AS busiest_wiki, w.n AS busiest_wiki_edits
FROM t LEFT JOIN w USING (name)"""),
    # windows
    "window_summary": with_edits(slices(300) + texts(
        300, "window_start, partition", "by_wiki", "by_type", "by_user", "totals", "partition")),
    "window_merged": with_edits(merged(300)),
    "window_latest": with_edits(merged(
        300, "WHERE window_start = (SELECT max(window_start) FROM m_total)")),
    "stored_timeline_1h": with_messages("," + timeline(604_800, 3_600).replace("FROM edits", "FROM clean").join(
        (" t AS (", ") SELECT * FROM t"))),
    "stored_top_wikis": with_messages(f""",
m AS (SELECT *, date_trunc('minute', ingested_at) AS minute FROM clean)
SELECT wiki, count(*) AS edits, count(*) FILTER (WHERE bot) AS bot_edits, count(DISTINCT "user") AS editors
FROM m WHERE minute >= {NOW} - INTERVAL 30 DAY GROUP BY 1 ORDER BY edits DESC, wiki LIMIT 10"""),
    "stored_window_latest": with_edits(
        slices(300) + MERGED + ", whole AS (" + texts(
            300, "window_start", "m_wiki", "m_type", "m_user", "(FROM m_total)", "partitions"
        ) + ")\nSELECT * EXCLUDE (top_editors) FROM whole WHERE window_start = (SELECT max(window_start) FROM whole)"),
    "window_points": with_edits(f"""
SELECT {floor_to('ingested_at', 300)} AS t, count(*) AS total, round(count(*) / 300, 2) AS rate,
       count(*) FILTER (WHERE bot) AS bot
FROM edits GROUP BY 1"""),
    "window_history": with_edits(f"""
SELECT {floor_to('ingested_at', 300)} AS t, count(*) AS total, round(count(*) / 300, 2) AS rate,
       count(*) FILTER (WHERE bot) AS bot
FROM edits GROUP BY 1 ORDER BY t DESC LIMIT 60"""),
    "window_trim": with_edits(f""",
s AS (
  SELECT {floor_to('ingested_at', 300)} AS window_start, kafka_partition AS partition, count(*) AS total_edits
  FROM edits GROUP BY ALL
)
SELECT * FROM s WHERE window_start IN (SELECT DISTINCT window_start FROM s ORDER BY 1 DESC LIMIT 120)"""),
    "window_ttl": with_edits(f"""
SELECT {floor_to('event_time', 300)} AS window_start, kafka_partition AS partition, count(*) AS total_edits,
       max(ingested_at) AS written_at
FROM edits GROUP BY 1, 2 HAVING {NOW_S} - max({epoch('ingested_at')}) < 86400"""),
    "window_point_rates": with_edits(f"""
SELECT {floor_to('ingested_at', 300)} AS t, round(count(*) / 300, 2) AS rate,
       round(count(*) / 300, 2) * (count(*) FILTER (WHERE bot) / count(*)) AS bot_rate
FROM edits GROUP BY 1"""),
    "window_view": with_edits(slices(86_400) + MERGED + """,
bars AS (
  SELECT window_start, count(*) AS active,
         string_agg(wiki || '=' || n || '=' || CAST(CAST(round(n * 100.0 / top, 3) AS DECIMAL(6, 3)) AS VARCHAR), ','
           ORDER BY n DESC, wiki) FILTER (WHERE place <= 8) AS wikis
  FROM (SELECT *, max(n) OVER (PARTITION BY window_start) AS top,
               row_number() OVER (PARTITION BY window_start ORDER BY n DESC, wiki) AS place FROM m_wiki)
  GROUP BY 1
)
SELECT window_start, round(total / 86400, 2) AS rate, total, bots * 100.0 / total AS bot_percent,
       CAST(active AS INT) AS active_wikis, wikis
FROM m_total JOIN bars USING (window_start)"""),
    "window_top_editors": with_edits(f"""
SELECT {floor_to('ingested_at', 86_400)} AS window_start, coalesce(nullif("user", ''), 'anonymous') AS "user",
       count(*) AS count, CAST(row_number() OVER (PARTITION BY {floor_to('ingested_at', 86_400)}
         ORDER BY count(*) DESC, coalesce(nullif("user", ''), 'anonymous')) AS INT) AS rank
FROM edits GROUP BY 1, 2 QUALIFY rank <= 5"""),
    "window_top_editors_slices": with_edits(slices(86_400) + """
SELECT window_start, usr AS "user", CAST(sum(n) AS BIGINT) AS count,
       CAST(row_number() OVER (PARTITION BY window_start ORDER BY sum(n) DESC, usr) AS INT) AS rank
FROM by_user GROUP BY window_start, usr QUALIFY rank <= 5"""),
    "window_top_editors_merged": with_edits(f"""
SELECT {floor_to('ingested_at', 86_400)} AS window_start, coalesce(nullif("user", ''), 'anonymous') AS "user",
       count(*) AS count, CAST(row_number() OVER (PARTITION BY {floor_to('ingested_at', 86_400)}
         ORDER BY count(*) DESC, coalesce(nullif("user", ''), 'anonymous')) AS INT) AS rank, 0::BIGINT AS error
FROM edits GROUP BY 1, 2 QUALIFY rank <= 5"""),
    "window_upsert": with_edits(f""",
v AS (
  SELECT {floor_to('ingested_at', 300)} AS window_start, kafka_partition AS partition, 1 AS version,
         count(*) AS total, count(*) FILTER (WHERE bot) AS bots FROM edits WHERE type <> 'error' GROUP BY 1, 2
  UNION ALL
  SELECT {floor_to('ingested_at', 300)}, kafka_partition, 2, count(*), count(*) FILTER (WHERE bot)
  FROM edits GROUP BY 1, 2
)
SELECT window_start, partition, total, bots, version FROM v
QUALIFY row_number() OVER (PARTITION BY window_start, partition ORDER BY version DESC) = 1"""),
    "window_changes": with_edits(f""",
s AS (
  SELECT {floor_to('event_time', 300)} AS window_start, poll AS version, count(*) AS n FROM edits GROUP BY 1, 2
),
v AS (
  SELECT window_start, version,
         CAST(sum(n) OVER (PARTITION BY window_start ORDER BY version) AS BIGINT) AS total FROM s
),
c AS (SELECT *, lag(total) OVER (PARTITION BY window_start ORDER BY version) AS previous FROM v)
SELECT * FROM c WHERE previous IS NULL OR previous <> total"""),
    "window_console_line": with_edits(slices(5) + MERGED + """,
t4 AS (
  SELECT window_start, string_agg(wiki || ': ' || n, ', ' ORDER BY n DESC, wiki) AS busiest
  FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, wiki) AS r FROM m_wiki)
  WHERE r <= 4 GROUP BY ALL
)
SELECT window_start, '[' || strftime(make_timestamp(window_start * 1000000), '%H:%M:%S') || '] '
         || printf('%5d', total) || ' edits (' || printf('%6.1f', round(total / 5, 2)) || '/s) | ' || busiest
         || ' | bots: ' || printf('%.0f', round_even(bots * 100.0 / total, 0)) || '%' AS line
FROM m_total JOIN t4 USING (window_start)"""),
    "window_breakdowns": with_edits(f"""
SELECT count(DISTINCT {floor_to('ingested_at', 300)}) AS windows, count(*) AS edits,
       count(DISTINCT {floor_to('ingested_at', 300)}) AS consistent FROM edits"""),
    # lateness
    "partition_watermark": with_edits(
        "SELECT kafka_partition, max(event_time) AS watermark FROM edits GROUP BY 1"),
    "running_watermark": with_edits("""
SELECT kafka_partition, kafka_offset,
       max(epoch_us(event_time)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_us,
       max(epoch_us(event_time)) OVER (o ROWS UNBOUNDED PRECEDING) AS watermark_us
FROM edits WINDOW o AS (PARTITION BY kafka_partition ORDER BY kafka_offset)"""),
    "watermark_lag": with_edits(f"""
SELECT kafka_partition, ({NOW_S}000000 - epoch_us(max(event_time))) / 1000000.0 AS lag_seconds
FROM edits GROUP BY 1"""),
    "late_events": with_edits(f""",
r AS (
  SELECT kafka_partition, kafka_offset, {floor_to('event_time', 300)} AS window_start,
         max(epoch_us(event_time)) OVER (PARTITION BY kafka_partition ORDER BY kafka_offset
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_us
  FROM edits
)
SELECT kafka_partition, kafka_offset, window_start FROM r
WHERE (window_start + 300 + 60) * 1000000 <= before_us"""),
    "late_disposition": with_edits(emitted(None) + """,
l AS (SELECT kafka_partition, count(*) FILTER (WHERE late) AS late_events FROM routed GROUP BY 1)
SELECT kafka_partition, late_events,
       CAST(coalesce(sum(events) FILTER (WHERE status = 'emitted'), 0) AS BIGINT) AS emitted_events,
       CAST(coalesce(sum(events) FILTER (WHERE status = 'dropped'), 0) AS BIGINT) AS dropped_events,
       CAST(coalesce(sum(events) FILTER (WHERE status = 'open'), 0) AS BIGINT) AS open_events
FROM fate JOIN l USING (kafka_partition) GROUP BY kafka_partition, late_events"""),
    "closed_disposition": with_edits(CLOSES + """
SELECT kafka_partition, count(*) FILTER (WHERE coalesce(closes <= before, false)) AS late_events,
       count(*) FILTER (WHERE NOT coalesce(closes <= before, false) AND closes <= mark) AS closed_events,
       count(*) FILTER (WHERE NOT coalesce(closes <= before, false) AND closes > mark) AS open_events
FROM r GROUP BY 1"""),
    "window_origin": with_edits(f""",
c AS (SELECT *, {floor_to('event_time', 300)} AS window_start FROM edits),
o AS (SELECT kafka_partition, arg_min(window_start, kafka_offset) AS origin FROM c GROUP BY 1)
SELECT kafka_partition, kafka_offset, window_start, origin, window_start < origin AS before_origin
FROM c JOIN o USING (kafka_partition)"""),
    "window_closed": with_edits(f""",
c AS (SELECT kafka_partition, {floor_to('event_time', 300)} AS window_start, count(*) AS events FROM edits GROUP BY 1, 2),
o AS (SELECT kafka_partition, max(epoch_us(event_time)) AS mark FROM edits GROUP BY 1)
SELECT kafka_partition, window_start, events FROM c JOIN o USING (kafka_partition)
WHERE (window_start + 360) * 1000000 <= mark"""),
    "window_dense": with_edits(f""",
c AS (SELECT kafka_partition, {floor_to('ingested_at', 300)} AS window_start, count(*) AS events FROM edits GROUP BY 1, 2),
g AS (
  SELECT kafka_partition, unnest(range(min(window_start), max(window_start) + 300, 300)) AS window_start
  FROM c GROUP BY 1
)
SELECT kafka_partition, window_start, coalesce(events, 0) AS events
FROM g LEFT JOIN c USING (kafka_partition, window_start)"""),
    "window_gaps_filled": with_edits(f""",
c AS (SELECT kafka_partition, {floor_to('ingested_at', 300)} AS window_start, count(*) AS events FROM edits GROUP BY 1, 2),
g AS (
  SELECT kafka_partition, unnest(range(min(window_start), max(window_start) + 300, 300)) AS window_start
  FROM c GROUP BY 1
)
SELECT kafka_partition, window_start, coalesce(events, 0) AS events
FROM g LEFT JOIN c USING (kafka_partition, window_start)"""),
    "window_gap_capped": with_edits(emitted(12) + "\nSELECT * FROM fate"),
    "window_gaps_skipped": with_edits(f""",
c AS (SELECT kafka_partition, {floor_to('ingested_at', 300)} AS window_start, count(*) AS events FROM edits GROUP BY 1, 2),
b AS (SELECT *, lag(window_start, 1, window_start - 300) OVER (PARTITION BY kafka_partition ORDER BY window_start) AS before FROM c)
SELECT kafka_partition, window_start, events, greatest(0, (window_start - before) // 300 - 1 - 12) AS skipped FROM b
UNION ALL
SELECT kafka_partition, unnest(range(greatest(before + 300, window_start - 3600), window_start, 300)), 0, 0 FROM b"""),
    "emit_delay": with_edits(DELAYS + "\nSELECT * FROM delays"),
    "slice_delay": with_edits(SLICE_DELAYS + "\nSELECT * FROM delays"),
    "restart_offsets": with_edits(CLOSES + """
SELECT kafka_partition, max(kafka_offset) + 1 AS end_offset,
       coalesce(min(kafka_offset) FILTER (WHERE closes > mark), max(kafka_offset) + 1) AS safe
FROM r GROUP BY 1"""),
    # checks
    "cold_path_health": with_messages(f""",
s AS (
  SELECT count(*) AS rows, count(*) FILTER (WHERE ingested_at >= TIMESTAMP '2024-01-30 23:00:00') AS new_rows,
         (epoch_us({NOW}) // 1000 - epoch_us(max(ingested_at)) // 1000) / 1000.0 AS age_seconds,
         (SELECT count(*) FROM dead) AS dead_letters
  FROM clean
)
SELECT *, CASE WHEN rows = 0 THEN 'empty' WHEN age_seconds <= 60 THEN 'ok' ELSE 'stale' END AS state,
       coalesce(rows > 0 AND new_rows > 0 AND age_seconds <= 60 AND dead_letters = 0, false) AS healthy
FROM s"""),
    "live_path_health": with_edits(f""",
w AS (SELECT {floor_to('ingested_at', 300)} AS w, kafka_partition FROM edits)
SELECT max(w) AS latest_window, {NOW_S} - (max(w) + 300) AS age_seconds,
       count(DISTINCT kafka_partition) AS partitions,
       CASE WHEN count(*) = 0 THEN 'no windows' WHEN {NOW_S} - (max(w) + 300) > 30 THEN 'no recent window'
            ELSE 'ok' END AS status
FROM w WHERE w = (SELECT max(w) FROM w)"""),
    "reconcile_hot_cold": f"""WITH {COPIES},
h AS (SELECT {floor_to('ingested_at', 300)} AS t, count(*) AS hot_edits FROM edits GROUP BY 1),
c AS (SELECT {floor_to('ingested_at', 300)} AS t, count(*) AS cold_edits FROM copies GROUP BY 1)
SELECT t, hot_edits, cold_edits, coalesce(cold_edits, 0) - coalesce(hot_edits, 0) AS difference,
       CASE WHEN hot_edits IS NULL THEN 'cold only' WHEN cold_edits IS NULL THEN 'hot only'
            WHEN hot_edits = cold_edits THEN 'equal' ELSE 'differs' END AS verdict
FROM h FULL JOIN c USING (t)""",
    # health series
    "counter_rate": with_edits(SAMPLES + """
SELECT 'events_consumed_total' AS metric, partition, ts // 3600 * 3600 AS t, sum(delta) AS increase,
       sum(delta) / 3600 AS rate
FROM deltas GROUP BY 2, 3"""),
    "counter_rate_rolling": with_edits(SAMPLES + """,
s AS (SELECT ts // 300 * 300 AS t, sum(delta) AS d FROM deltas GROUP BY 1)
SELECT 'events_consumed_total' AS metric, t,
       sum(d) OVER (ORDER BY t RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) / 3600 AS rate
FROM s"""),
    "gauge_by_label": with_edits(SAMPLES + gauge("max", "partition", 3600)),
    "gauge_total": with_edits(SAMPLES + gauge("sum", "''", 3600)),
    "histogram_buckets": with_edits(BUCKETS + "\nSELECT * FROM buckets"),
    "histogram_quantile": with_edits(BUCKETS + """,
x AS (
  SELECT *, lag(le, 1, 0) OVER o AS low, lag(cumulative, 1, 0) OVER o AS below,
         0.99::DOUBLE * max(cumulative) OVER (PARTITION BY kafka_partition) AS rank_
  FROM buckets WINDOW o AS (PARTITION BY kafka_partition ORDER BY le)
)
SELECT kafka_partition, arg_min(CASE WHEN isinf(le) THEN low
         ELSE low + (le - low) * (rank_ - below) / (cumulative - below) END, le) AS p99
FROM x WHERE cumulative >= rank_ GROUP BY 1"""),
    "stored_batches": with_messages("""
SELECT CASE WHEN "timestamp" < TIMESTAMP '2024-01-15' THEN 0::BIGINT ELSE 1::BIGINT END AS batch_id, partition AS kafka_partition,
       min("offset") AS low, max("offset") AS high, count(*) AS messages, max("timestamp") AS newest
FROM j GROUP BY 1, 2"""),
    "consumer_lag": with_messages(""",
z AS (SELECT partition, max("offset") + 1 AS end_offset FROM messages GROUP BY 1),
d AS (SELECT partition, max("offset") + 1 AS committed FROM j WHERE "timestamp" < TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT partition, end_offset - coalesce(committed, 0) AS lag, CAST(sum(end_offset - coalesce(committed, 0)) OVER () AS BIGINT) AS total_lag
FROM z LEFT JOIN d USING (partition)"""),
    "rate_quantile": with_edits(values(
        "SELECT 'p99' AS name, 'within' AS metric, 'rate' AS reading, 21600 AS win, 0.99::DOUBLE AS q, partition, "
        "'partition=' || partition AS labels FROM (SELECT DISTINCT partition FROM counted)") + "\nSELECT labels, t, value FROM told"),
    "rule_values": with_edits(values(rule_readers()) + "\nSELECT * FROM told"),
    "status_bands": with_edits(SAMPLES + """
SELECT partition AS label, ts // 300 * 300 AS t, arg_max(lag, ts) AS value,
       CASE WHEN arg_max(lag, ts) >= 600 THEN 'red' WHEN arg_max(lag, ts) >= 300 THEN 'yellow'
            ELSE 'green' END AS band
FROM counted GROUP BY 1, 2"""),
    "alert_states": with_edits(values(rule_readers()) + "\n" + rule_states()),
}
ORACLES["rollup_read_parts"] = ORACLES["rollup_1m"]
