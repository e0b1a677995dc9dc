"""The telemetry queries in DuckDB SQL, written from the rules rather than from the plans."""

from __future__ import annotations

PLAYER = """
base AS (
    SELECT *, (props::JSON->>'$.k')::INTEGER AS k, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1440000 AS ms0, user_id % 6 <> 5 AS ends FROM events),
kinds AS (
    SELECT *, CASE event_type WHEN 'view' THEN 'heartbeat' WHEN 'signup' THEN 'video_start'
        WHEN 'purchase' THEN CASE WHEN k >= 50 AND ends THEN 'video_end' ELSE 'bitrate_switch' END
        WHEN 'error' THEN CASE WHEN k < 5 AND ends THEN 'error' WHEN k % 2 = 0 THEN 'ad_start' ELSE 'ad_end' END ELSE 'buffer_start' END AS kind,
        floor(value)::BIGINT * CASE WHEN user_id % 4 = 1 AND ms0 // 60000 BETWEEN 10 AND 14 THEN 100 ELSE 1 END AS gap FROM base),
ended AS (
    SELECT event_id, user_id, k, kind, ms0 AS ms, '' AS tail, 0 AS more FROM kinds
    UNION ALL SELECT event_id, user_id, k, 'buffer_end', ms0 + gap, '-end', 1 FROM kinds WHERE kind = 'buffer_start'),
copies AS (SELECT *, 0 AS again FROM ended UNION ALL SELECT *, 1 FROM ended WHERE event_id % 100 = 0),
player AS (
    SELECT 'e' || event_id || tail AS event_id, 's' || user_id AS session_id, 'u' || user_id AS user_id, TIMESTAMP '2024-01-01' + to_microseconds(ms * 1000) AS event_time, kind AS event_type,
        'c' || (user_id % 20) AS content_id, true AS is_live, CASE user_id % 3 WHEN 0 THEN 'smart_tv' WHEN 1 THEN 'mobile' ELSE 'web' END AS device_type, 'm' AS device_model, 'os' AS device_os, '1' AS app_version,
        r_name AS geo_region, 'st' AS geo_state, 'ci' AS geo_city, 'isp' AS geo_isp, 'cdn-' || chr((97 + user_id % 4)::INTEGER) AS cdn, CASE WHEN k = 99 THEN 0 ELSE 1000 + 50 * k END AS bitrate_kbps,
        100 * k AS buffer_length_ms, (ms // 1000)::INTEGER AS playhead_position_s, CASE WHEN kind = 'error' THEN 'E' || k END AS error_code, CASE WHEN k BETWEEN 7 AND 9 THEN 'v2' END AS schema_version,
        CASE k WHEN 7 THEN 'cellular' WHEN 8 THEN 'wifi' WHEN 9 THEN 'ethernet' END AS network_type, strftime(TIMESTAMP '2024-01-01' + to_microseconds(ms * 1000), '%Y-%m-%dT%H') AS event_hour,
        TIMESTAMP '2024-01-01' + to_microseconds((ms + event_id % 16 * 1000 + again * 1000) * 1000) AS _ingested_at, (user_id % 6)::INTEGER AS _kafka_partition, 2 * event_id + more + again * 1000000000 AS _kafka_offset
    FROM copies JOIN region ON r_regionkey = user_id % 5)"""

DEDUPED = PLAYER + """,
deduped AS (SELECT * FROM player QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at, _kafka_offset) = 1)"""

EV = DEDUPED + """,
ev AS (SELECT * EXCLUDE (network_type), coalesce(network_type, 'unknown') AS network_type, date_trunc('minute', event_time) AS window_start FROM deduped)"""

CONTENT = """
versions AS (
    SELECT 'c' || p_partkey AS content_id, p_name AS title, p_type AS genre, p_size > 25 AS is_premium, '2023-12-01' AS updated_at FROM part
    UNION ALL SELECT 'c' || p_partkey, p_name || ' (rev)', p_type, p_size > 25, '2023-12-15' FROM part WHERE p_partkey % 2 = 0),
content AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY updated_at DESC) = 1)"""

MARKERS = """
markers AS (
    SELECT 'm' || n_nationkey AS marker_id, 1000 + n_nationkey AS event_id_scte, TIMESTAMP '2024-01-01' + to_seconds(72 * n_nationkey + 15) AS starts, CASE WHEN n_nationkey % 2 = 0 THEN 30 ELSE 60 END AS duration_s,
        CASE n_nationkey % 5 WHEN 4 THEN 'program_boundary' WHEN 3 THEN 'blackout' ELSE 'commercial' END AS break_type FROM nation),
breaks AS (SELECT *, starts + to_seconds(duration_s) AS ends FROM markers WHERE break_type IN ('commercial', 'blackout'))"""

ADS = """
ads AS (
    SELECT (1000 + o_orderkey % 27)::INTEGER AS event_id_scte, 'adv' || (o_custkey % 10) AS advertiser_id, 'Advertiser ' || (o_custkey % 10) AS advertiser_name, 'cr' || (o_custkey % 30) AS creative_id,
        CASE WHEN o_orderkey % 2 = 0 THEN 15 ELSE 30 END AS creative_duration_s, floor(o_totalprice / 100 + 0.5)::BIGINT AS cents FROM orders)"""

PAIRS = """
buffers AS (
    SELECT session_id, window_start, event_type, event_time, lead(event_time) OVER w AS next_time, lead(event_type) OVER w AS next_type FROM ev
    WHERE event_type IN ('buffer_start', 'buffer_end') WINDOW w AS (PARTITION BY session_id ORDER BY event_time, event_id)),
pairs AS (
    SELECT session_id, window_start, sum(CASE WHEN event_type = 'buffer_start' AND next_type = 'buffer_end' THEN epoch_ms(next_time) - epoch_ms(event_time) ELSE 0 END)::BIGINT AS rebuffer_ms
    FROM buffers GROUP BY 1, 2)"""

ENDED = "ended_sessions AS (SELECT session_id, bool_or(event_type IN ('video_end', 'error')) AS session_complete FROM ev GROUP BY 1)"

MART = f"""{EV}, {CONTENT}, {PAIRS}, {ENDED},
folded AS (
    SELECT session_id, window_start, {", ".join(f"arg_min({c}, (event_time, event_id)) FILTER ({c} IS NOT NULL) AS {c}" for c in ("geo_region", "device_type", "cdn", "network_type", "content_id"))},
        count(*) AS events, count(*) FILTER (event_type = 'error') AS error_count, avg(CASE WHEN event_type IN ('heartbeat', 'video_start', 'bitrate_switch') THEN bitrate_kbps END) AS bitrate,
        count(*) FILTER (event_type = 'buffer_start') AS buffer_start_count, bool_or(event_type = 'video_start') AS had_video_start, bool_or(event_type IN ('video_end', 'error')) AS had_terminal,
        epoch_ms(max(event_time)) - epoch_ms(min(event_time)) AS span FROM ev GROUP BY 1, 2),
joined AS (
    SELECT f.*, c.title, c.genre, c.is_premium, s.session_complete, coalesce(p.rebuffer_ms, 0) AS rebuffer_ms, greatest(0, span - coalesce(p.rebuffer_ms, 0)) AS watch_ms
    FROM folded f LEFT JOIN pairs p USING (session_id, window_start) LEFT JOIN ended_sessions s ON s.session_id = f.session_id LEFT JOIN content c ON c.content_id = f.content_id),
mart AS (
    SELECT session_id, window_start, window_start + INTERVAL 1 MINUTE AS window_end, strftime(window_start, '%Y-%m-%dT%H') AS window_hour, session_id || '|' || strftime(window_start, '%Y-%m-%dT%H:%M') AS window_key,
        geo_region, device_type, cdn, network_type, content_id, title AS content_title, genre AS content_genre, is_premium AS content_is_premium, session_complete, events, rebuffer_ms, watch_ms,
        CASE WHEN rebuffer_ms + watch_ms > 0 THEN rebuffer_ms::DOUBLE / (rebuffer_ms + watch_ms) ELSE 0 END AS rebuffering_ratio, coalesce(bitrate, 0) AS avg_bitrate_kbps, error_count,
        error_count::DOUBLE / events AS error_rate, buffer_start_count, had_video_start, had_terminal AND NOT had_video_start AS exit_before_video_start FROM joined)"""

# Pairs inside a window: a start meets an end that is the window's next buffer event.
SPEED = f"""{EV},
near AS (
    SELECT session_id, window_start, event_type, event_time, lead(event_time) OVER w AS next_time, lead(event_type) OVER w AS next_type FROM ev
    WHERE event_type IN ('buffer_start', 'buffer_end') WINDOW w AS (PARTITION BY session_id, window_start ORDER BY event_time, event_id)),
near_pairs AS (
    SELECT session_id, window_start, sum(CASE WHEN event_type = 'buffer_start' AND next_type = 'buffer_end' THEN epoch_ms(next_time) - epoch_ms(event_time) ELSE 0 END)::BIGINT AS rebuffer_ms FROM near GROUP BY 1, 2),
speed_folded AS (
    SELECT session_id, window_start, {", ".join(f"arg_min({c}, (event_time, event_id)) FILTER ({c} <> '') AS {c}" for c in ("geo_region", "device_type", "cdn"))}, count(*) AS events,
        coalesce(sum(bitrate_kbps) FILTER (event_type IN ('heartbeat', 'video_start', 'bitrate_switch')), 0)::BIGINT AS bits,
        count(*) FILTER (event_type IN ('heartbeat', 'video_start', 'bitrate_switch') AND bitrate_kbps <> 0) AS n_bits, count(*) FILTER (event_type = 'error') AS error_count,
        count(*) FILTER (event_type = 'buffer_start') AS buffer_start_count, bool_or(event_type = 'video_start') AS had_video_start, bool_or(event_type IN ('video_end', 'error')) AS had_terminal,
        epoch_ms(max(event_time)) - epoch_ms(min(event_time)) AS span FROM ev GROUP BY 1, 2),
speed_joined AS (SELECT f.*, coalesce(p.rebuffer_ms, 0) AS rebuffer_ms, greatest(0, span - coalesce(p.rebuffer_ms, 0)) AS watch_ms FROM speed_folded f LEFT JOIN near_pairs p USING (session_id, window_start)),
speed AS (
    SELECT session_id, geo_region, device_type, cdn, events, rebuffer_ms, watch_ms,
        CASE WHEN rebuffer_ms + watch_ms > 0 THEN ((2000000 * rebuffer_ms + rebuffer_ms + watch_ms) // (2 * (rebuffer_ms + watch_ms)))::DOUBLE / 1000000 ELSE 0 END AS rebuffering_ratio,
        CASE WHEN n_bits > 0 THEN ((200 * bits + n_bits) // (2 * n_bits))::DOUBLE / 100 ELSE 0 END AS avg_bitrate_kbps, error_count, ((2000000 * error_count + events) // (2 * events))::DOUBLE / 1000000 AS error_rate,
        buffer_start_count, had_video_start, had_terminal AND NOT had_video_start AS exit_before_video_start, window_start, window_start + INTERVAL 1 MINUTE AS window_end,
        strftime(window_start, '%Y-%m-%dT%H-') || (minute(window_start) // 10) || '0' AS window_bucket FROM speed_joined)"""

CCV = f"{MART}, viewers AS (SELECT window_start, window_hour, geo_region, device_type, cdn, count(DISTINCT session_id) AS ccv FROM mart GROUP BY ALL)"

IMPACT = f"""{MART}, {MARKERS}, {ADS},
active AS (SELECT marker_id, event_id_scte, break_type, count(DISTINCT session_id) AS active_sessions FROM breaks JOIN mart ON window_start < ends AND window_end > starts GROUP BY 1, 2, 3),
sold AS (SELECT event_id_scte, count(*) AS n, sum(cents)::BIGINT AS cents FROM ads GROUP BY 1),
impact AS (
    SELECT marker_id, a.event_id_scte, break_type, active_sessions, coalesce(n, 0) AS ad_impressions, coalesce(cents, 0) / 100 AS sum_cpm_brl, ((coalesce(cents, 0) * coalesce(n, 0) + 500) // 1000) / 100 AS est_revenue_brl
    FROM active a LEFT JOIN sold s ON s.event_id_scte = a.event_id_scte)"""

CREATIVES = f"""{MARKERS}, {ADS},
creative AS (SELECT event_id_scte, advertiser_id, advertiser_name, creative_id, max(creative_duration_s) AS creative_duration_s, count(*) AS ad_impressions, sum(cents)::BIGINT AS cents FROM ads GROUP BY 1, 2, 3, 4),
creatives AS (
    SELECT c.event_id_scte, break_type, advertiser_id, advertiser_name, creative_id, creative_duration_s, ad_impressions, cents / 100 AS sum_cpm_brl, ((cents * ad_impressions + 500) // 1000) / 100 AS est_revenue_brl
    FROM creative c LEFT JOIN breaks b ON b.event_id_scte = c.event_id_scte)"""


def _burn(bad: str, total: str) -> str:
    sums = ", ".join(f"sum({c}) OVER w{n}::BIGINT AS {c}_{n}" for n in (1, 5, 30) for c in ("total", "bad", "samples"))
    frames = ", ".join(f"w{n} AS (PARTITION BY cdn ORDER BY minute RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (1, 5, 30))
    burns = ", ".join(f"CASE WHEN total_{n} > 0 THEN bad_{n}::DOUBLE / total_{n} / 0.01 ELSE 0 END AS burn_{n}" for n in (1, 5, 30))
    return f"""
minutes AS (SELECT coalesce(nullif(cdn, ''), 'unknown') AS cdn, epoch_ms(window_start) // 60000 AS minute, sum({total})::BIGINT AS total, sum({bad})::BIGINT AS bad, sum(events)::BIGINT AS samples FROM speed GROUP BY 1, 2),
sums AS (SELECT *, {sums} FROM minutes WINDOW {frames}),
burns AS (SELECT *, {burns} FROM sums),
evaluated AS (SELECT *, CASE WHEN samples_5 >= 50 AND burn_5 >= 4 AND burn_1 >= 4 THEN 'page' WHEN samples_30 >= 50 AND burn_30 >= 2 AND burn_5 >= 2 THEN 'ticket' END AS tier FROM burns)"""


def _latch(order: str) -> str:
    return f"""
numbered AS (SELECT *, row_number() OVER (PARTITION BY cdn ORDER BY {order}) AS n FROM evaluated),
runs AS (
    SELECT *, n - coalesce(max(CASE WHEN tier IS NULL THEN n END) OVER w, 0) AS run_on, n - coalesce(max(CASE WHEN tier IS NOT NULL THEN n END) OVER w, 0) AS run_off, last_value(tier IGNORE NULLS) OVER w AS last_tier
    FROM numbered WINDOW w AS (PARTITION BY cdn ORDER BY n ROWS UNBOUNDED PRECEDING)),
states AS (
    SELECT *, coalesce(last_value(CASE WHEN run_on >= 2 THEN 1 WHEN run_off >= 3 THEN 0 END IGNORE NULLS) OVER (PARTITION BY cdn ORDER BY n ROWS UNBOUNDED PRECEDING), 0) AS now_on FROM runs),
changes AS (SELECT *, coalesce(lag(now_on) OVER (PARTITION BY cdn ORDER BY n), 0) AS was_on FROM states),
transitions AS (SELECT cdn, CASE WHEN now_on = 1 THEN 'FIRING' ELSE 'RESOLVED' END AS state, last_tier AS tier, minute FROM changes WHERE now_on <> was_on)"""


BURN = SPEED + "," + _burn("rebuffer_ms", "rebuffer_ms + watch_ms")
ALERTS = BURN + "," + _latch("minute")

_ROW_SUMS = ", ".join(
    f"(sum({c}) OVER (PARTITION BY cdn ORDER BY minute, session_id ROWS UNBOUNDED PRECEDING) - coalesce(sum({c}) OVER (PARTITION BY cdn ORDER BY minute RANGE BETWEEN UNBOUNDED PRECEDING AND {n} PRECEDING), 0))::BIGINT AS {c}_{n}"
    for n in (1, 5, 30)
    for c in ("total", "bad", "samples")
)
ROW_ALERTS = f"""{SPEED},
rows_ AS (SELECT coalesce(nullif(cdn, ''), 'unknown') AS cdn, epoch_ms(window_start) // 60000 AS minute, session_id, rebuffer_ms + watch_ms AS total, rebuffer_ms AS bad, events AS samples FROM speed),
sums AS (SELECT *, {_ROW_SUMS} FROM rows_),
burns AS (SELECT *, {", ".join(f"CASE WHEN total_{n} > 0 THEN bad_{n}::DOUBLE / total_{n} / 0.01 ELSE 0 END AS burn_{n}" for n in (1, 5, 30))} FROM sums),
evaluated AS (SELECT *, CASE WHEN samples_5 >= 50 AND burn_5 >= 4 AND burn_1 >= 4 THEN 'page' WHEN samples_30 >= 50 AND burn_30 >= 2 AND burn_5 >= 2 THEN 'ticket' END AS tier FROM burns),{_latch("minute, session_id")}"""

CURRENT = ALERTS + ", latest AS (SELECT cdn, arg_max(state, minute) AS state, arg_max(tier, minute) AS tier FROM transitions GROUP BY cdn)"


def _nulls(mart: str, source: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(f"SELECT '{mart}' AS mart, 'not_null_{c}' AS check_name, count(*) FILTER ({c} IS NULL) AS violations FROM {source}" for c in columns)


_RATIO = "coalesce(sum(rebuffer_ms)::DOUBLE / nullif(sum(rebuffer_ms + watch_ms), 0), 0)"
_EVERY = f"{IMPACT}, viewers AS (SELECT window_start, window_hour, geo_region, device_type, cdn, count(DISTINCT session_id) AS ccv FROM mart GROUP BY ALL), creative AS {CREATIVES.split('creative AS ', 1)[1]}"


_SLICE = "epoch_ms({}) // 300000"
_STREAMED = f"{PLAYER}, batches AS (SELECT *, {_SLICE.format('_ingested_at')} AS batch FROM player), latest AS (SELECT batch, max(event_time) AS latest FROM batches GROUP BY 1), earlier AS (SELECT batch, max(latest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM latest)"
_TAGGED = f"""{SPEED}, {MARKERS},
            tagged AS (SELECT session_id, window_start, marker_id, break_type, event_id_scte, row_number() OVER (PARTITION BY session_id, window_start ORDER BY starts, marker_id) AS n
                FROM speed LEFT JOIN breaks ON window_start BETWEEN starts - INTERVAL 5 SECOND AND ends + INTERVAL 5 SECOND)
            SELECT session_id, window_start, marker_id, break_type, event_id_scte::BIGINT AS scte_event_id FROM tagged WHERE n = 1"""
_COUNTS = (("session_window_qoe", "mart"), ("ccv", "viewers"), ("ad_impact", "impact"), ("ad_creatives", "creatives"))


def _errors(budget: str) -> str:
    return f"WITH {SPEED},{_burn('error_count', 'events').replace('/ 0.01', f'/ {budget}')},{_latch('minute')} SELECT * FROM transitions"


def flow_sql() -> dict[str, str]:
    """What landing, tables, contracts and streams give, from the rules of their input."""
    return {
        "flatten_player": f"WITH {PLAYER} SELECT * FROM player",
        "flatten_markers": f"""WITH {MARKERS} SELECT marker_id, 'ch' AS channel, 'splice_insert' AS splice_command, event_id_scte, true AS out_of_network, ((event_id_scte - 1000) * 90000)::BIGINT AS pts_time, starts AS wallclock, duration_s, break_type,
            TIMESTAMP '2024-01-01' AS _ingested_at, 0 AS _kafka_partition, (event_id_scte - 1000)::BIGINT AS _kafka_offset FROM markers""",
        "flatten_content": f"WITH {CONTENT} SELECT content_id, title, genre, is_premium, updated_at, NULL::VARCHAR AS language, substr(content_id, 2)::BIGINT AS _kafka_offset FROM versions",
        "decode_loose": f"WITH {PLAYER} SELECT session_id, count(*) AS events FROM player WHERE _kafka_offset % 50 <> 0 GROUP BY 1",
        "publish_and_read": f"WITH {PLAYER} SELECT event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp, schema_version, network_type, count(*) AS copies FROM player GROUP BY ALL",
        "ad_feed": f"WITH {ADS} SELECT 'there' AS feed, count(*) AS decisions, sum(cents)::BIGINT / 100 AS cpm, 0::BIGINT AS served FROM ads UNION ALL SELECT 'absent', 0, NULL, 0",
        "replay_slices": f"""WITH {PLAYER}, {MARKERS} SELECT 'player_events' AS topic, (epoch_ms(event_time) // 300000)::BIGINT AS slice, count(*) AS messages, true AS in_order FROM player GROUP BY ALL
            UNION ALL SELECT 'scte35_markers', (epoch_ms(starts) // 300000)::BIGINT, count(*), true FROM markers GROUP BY ALL""",
        "read_as_versions": f"WITH {PLAYER} SELECT 'v2 reads v1' AS reader, 'unknown' AS network_type, 'v1' AS schema_version, count(*) AS records FROM player UNION ALL SELECT 'v1 reads v2', NULL, NULL, count(*) FROM player",
        "out_of_domain": f"""WITH {PLAYER}, odd AS (SELECT CASE WHEN _kafka_offset % 40 = 0 THEN 'odd' ELSE event_type END AS event_type, CASE WHEN _kafka_offset % 30 = 0 THEN 'pigeon' ELSE network_type END AS network_type FROM player)
            SELECT event_type, network_type, count(*) AS refused FROM odd WHERE event_type = 'odd' OR network_type = 'pigeon' GROUP BY ALL""",
        "registered_contracts": """SELECT * FROM (VALUES ('player_events-value', 2, NULL), ('scte35_markers-value', 1, NULL), ('content_metadata-value', 1, NULL), ('a field without a default', 0, 'must'), ('another type', 0, 'bitrate_kbps'), ('a narrower domain', 0, 'event_type')) AS t(subject, version, fault)""",
        "bronze_overwrite": f"WITH {PLAYER} SELECT strftime(event_time, '%Y-%m-%dT%H-%M') AS part, count(*) AS events, 2 AS version FROM player WHERE session_id <> 's1' AND minute(event_time) < 10 GROUP BY 1",
        "upsert_windows": f"""WITH {SPEED}, w AS (SELECT *, minute(window_start) < 12 AND substr(session_id, 2)::BIGINT % 5 = 0 AS again FROM speed)
            SELECT session_id, window_start, window_bucket, events + CASE WHEN again THEN 1 ELSE 0 END AS events, CASE WHEN again THEN 'm' END AS marker_id FROM w""",
        "compacted_table": f"WITH {SPEED} SELECT window_bucket, count(*) AS windows, sum(events)::BIGINT AS events, 1::BIGINT AS files FROM speed GROUP BY 1",
        "batch_run": f"WITH {_EVERY}, c AS (" + " UNION ALL ".join(f"SELECT '{m}' AS mart, count(*) AS n_rows FROM {s}" for m, s in _COUNTS) + ") SELECT mart, n_rows, n_rows AS exported, 1::BIGINT AS bronze_version FROM c",
        "table_catalog": "SELECT * FROM (VALUES ('markers', true, 2, true, false), ('absent', false, 0, false, false)) AS t(name, present, version, has_break_type, none)",
        "absent_marts": "SELECT unnest(['ccv_by_region', 'qoe_by_network_type', 'ad_impact', 'ad_creatives', 'rebuffering_by_cdn', 'unique_views_per_minute', 'avg_bitrate_by_cdn', 'known_cdns', 'current_alerts', 'cdn_health']) AS panel, 0::BIGINT AS n_rows",
        "display_order": f"""WITH {CCV}, r AS (SELECT geo_region AS region, max(ccv) AS peak_ccv, ((20 * sum(ccv) + count(*)) // (2 * count(*)))::DOUBLE / 10 AS avg_ccv FROM viewers GROUP BY 1)
            SELECT row_number() OVER (ORDER BY peak_ccv DESC, region, avg_ccv)::INTEGER AS place, * FROM r""",
        "gold_checksum_ordered": f"WITH {MART} SELECT md5(string_agg(concat_ws('|', window_key, events, error_count, rebuffer_ms, (floor(rebuffering_ratio * 1e6 + 0.5) / 1e6)::VARCHAR), '' ORDER BY window_key)) AS qoe_checksum FROM mart",
        "error_alert_transitions": _errors("0.01"),
        "error_slo_ticket": _errors("0.001"),
        "watermark_lag": f"WITH {_STREAMED} SELECT quantile_cont((epoch_ms(latest) - epoch_ms(before - INTERVAL 40 SECOND)) / 1000, 0.95) AS lag_p95_s FROM latest JOIN earlier USING (batch) WHERE before IS NOT NULL",
        "mart_age": "SELECT 18.5::DOUBLE AS age_hours",
        "stream_windows": f"WITH {SPEED} SELECT * FROM speed",
        "stream_markers": f"WITH {_TAGGED}",
        "stream_upserts": f"WITH {SPEED} SELECT window_bucket, count(*) AS windows, sum(events)::BIGINT AS events FROM speed GROUP BY 1",
        "stream_alerts": f"WITH {ALERTS} SELECT * FROM transitions",
        "stream_bounded_dedupe": f"WITH {DEDUPED} SELECT session_id, count(*) AS events, count(*) AS ids FROM deduped GROUP BY 1",
        "stream_late_rows": f"WITH {_STREAMED} SELECT event_id, session_id, count(*) AS copies FROM batches JOIN earlier USING (batch) WHERE event_time < before - INTERVAL 3 SECOND GROUP BY 1, 2",
        "stream_late_share": "SELECT count(*) AS tapped, count(*) FILTER (r_regionkey = 4)::DOUBLE / count(*) AS late_share FROM region",
        "bounded_drain": f"WITH {PLAYER} SELECT event_type, count(*) AS messages, count(*) AS landed FROM player GROUP BY 1",
    }


def oracle_sql() -> dict[str, str]:
    return flow_sql() | {
        "dedupe_global": f"WITH {DEDUPED} SELECT event_id, session_id, event_time, event_type, _ingested_at, _kafka_offset FROM deduped",
        "scd_latest": f"WITH {CONTENT} SELECT * FROM content",
        "default_fill_network_type": f"WITH {EV} SELECT network_type, count(*) AS events FROM ev GROUP BY 1",
        "session_complete": f"WITH {EV}, {ENDED} SELECT * FROM ended_sessions",
        "rebuffer_pairs": f"WITH {EV}, {PAIRS} SELECT * FROM pairs",
        "session_window_qoe": f"WITH {MART} SELECT * FROM mart",
        "ccv": f"WITH {CCV} SELECT * FROM viewers",
        "ad_impact": f"WITH {IMPACT} SELECT * FROM impact",
        "ad_creatives": f"WITH {CREATIVES} SELECT * FROM creatives",
        "silver_qoe": f"WITH {SPEED} SELECT * FROM speed",
        "silver_marker_enrich": f"WITH {_TAGGED}",
        "silver_dedup_on_read": f"WITH {SPEED} SELECT session_id, window_start, events + CASE WHEN substr(session_id, 2)::BIGINT % 5 = 0 THEN 1 ELSE 0 END AS events, CASE WHEN substr(session_id, 2)::BIGINT % 5 = 0 THEN 2 ELSE 1 END AS processed_at FROM speed",
        "burn_rate_by_minute": f"WITH {BURN} SELECT * FROM evaluated",
        "cdn_alert_transitions": f"WITH {ALERTS} SELECT * FROM transitions",
        "cdn_alert_transitions_by_row": f"WITH {ROW_ALERTS} SELECT * FROM transitions",
        "current_alerts": f"WITH {CURRENT} SELECT * FROM latest",
        "known_cdns": f"WITH {SPEED} SELECT DISTINCT cdn FROM speed WHERE cdn IS NOT NULL",
        "ccv_by_region": f"WITH {CCV} SELECT geo_region AS region, max(ccv) AS peak_ccv, ((20 * sum(ccv) + count(*)) // (2 * count(*)))::DOUBLE / 10 AS avg_ccv FROM viewers GROUP BY 1",
        "rebuffering_by_cdn": f"WITH {SPEED} SELECT window_start, cdn, {_RATIO} AS rebuffering_ratio FROM speed GROUP BY 1, 2",
        "unique_views_per_minute": f"WITH {SPEED} SELECT date_trunc('minute', window_start) AS minute, count(DISTINCT session_id) AS unique_views FROM speed GROUP BY 1",
        "avg_bitrate_by_cdn": f"WITH {SPEED} SELECT window_start, cdn, sum(avg_bitrate_kbps::DECIMAL(14,2) * watch_ms)::DOUBLE / sum(watch_ms) AS avg_bitrate_kbps FROM speed WHERE watch_ms > 0 GROUP BY 1, 2",
        "qoe_by_network_type": f"WITH {MART} SELECT network_type, count(*) AS windows, {_RATIO} AS rebuffering_ratio, round(avg(avg_bitrate_kbps), 0) AS avg_bitrate_kbps FROM mart GROUP BY 1",
        "ad_impact_panel": f"WITH {IMPACT} SELECT * EXCLUDE (marker_id) FROM impact",
        "ad_creatives_panel": f"WITH {CREATIVES} SELECT * FROM creatives",
        "cdn_health": f"""WITH {CURRENT}, firing AS (SELECT cdn, tier FROM latest WHERE state = 'FIRING'), known AS (SELECT DISTINCT cdn FROM speed WHERE cdn IS NOT NULL)
            SELECT cdn, CASE WHEN tier IS NULL THEN 'healthy' ELSE 'firing' END AS health, tier FROM known FULL JOIN firing USING (cdn)""",
        "gold_checksum": f"""WITH {MART}, hashed AS (SELECT ('0x' || substr(md5(concat_ws('|', window_key, events, error_count, rebuffer_ms, rebuffering_ratio::DECIMAL(18,6))), 1, 15))::BIGINT AS h FROM mart)
            SELECT count(*) AS n_rows, md5(count(*) || ':' || sum(h)) AS qoe_checksum FROM hashed""",
        "mart_row_counts": f"WITH {_EVERY} " + " UNION ALL ".join(f"SELECT '{m}' AS mart, count(*) AS n_rows FROM {s}" for m, s in (("session_window_qoe", "mart"), ("ccv", "viewers"), ("ad_impact", "impact"), ("ad_creatives", "creatives"))),
        "dq_violations": f"WITH {_EVERY} "
        + " UNION ALL ".join(
            [
                _nulls("session_window_qoe", "mart", ("window_key", "session_id", "window_start", "rebuffering_ratio", "session_complete")), _nulls("ccv", "viewers", ("ccv",)), _nulls("ad_impact", "impact", ("event_id_scte",)),
                "SELECT 'ad_impact', 'accepted_break_type', count(*) FILTER (break_type NOT IN ('commercial', 'blackout')) FROM impact", _nulls("ad_creatives", "creatives", ("event_id_scte", "advertiser_name", "creative_id")),
                "SELECT 'session_window_qoe', 'unique_window_key', count(*) FROM (SELECT window_key FROM mart GROUP BY 1 HAVING count(*) > 1)",
            ]
        ),
        "ingestion_lag_p95": f"WITH {PLAYER} SELECT cdn, quantile_cont((epoch_ms(_ingested_at) - epoch_ms(event_time)) / 1000, 0.95) AS lag_p95_s FROM player GROUP BY 1",
        "event_count_band": f"""WITH {PLAYER}, counts AS (SELECT epoch_ms(event_time) // 60000 AS minute, count(*) AS n FROM player GROUP BY 1),
            medians AS (SELECT minute, n, quantile_cont(n::DOUBLE, 0.5) OVER (ORDER BY minute RANGE BETWEEN 15 PRECEDING AND 1 PRECEDING) AS median FROM counts)
            SELECT *, n BETWEEN median * 0.6::DOUBLE AND median * 3.0::DOUBLE AS in_band FROM medians""",
        "dedupe_ratio": f"WITH {PLAYER} SELECT count(*) AS messages, count(DISTINCT event_id) AS events, (count(*) - count(DISTINCT event_id))::DOUBLE / count(*) AS dedupe_ratio FROM player",
        "schema_v2_share": f"WITH {PLAYER} SELECT count(*) AS messages, count(network_type) AS v2, count(network_type)::DOUBLE / count(*) AS v2_share FROM player",
        "error_burn": f"WITH {SPEED},{_burn('error_count', 'events')} SELECT cdn, minute, bad, total, burn_1 AS burn_short, burn_5 AS burn_long, tier FROM evaluated",
        "silver_gold_divergence": f"""WITH {MART}, {SPEED.replace(EV + ',', '', 1)},
            s AS (SELECT cdn, window_start, {_RATIO} AS speed_ratio FROM speed GROUP BY 1, 2), g AS (SELECT cdn, window_start, {_RATIO} AS batch_ratio FROM mart GROUP BY 1, 2),
            j AS (SELECT cdn, window_start, coalesce(speed_ratio, 0) AS speed_ratio, coalesce(batch_ratio, 0) AS batch_ratio FROM s FULL JOIN g USING (cdn, window_start)),
            d AS (SELECT *, CASE WHEN batch_ratio > 0 THEN abs(speed_ratio - batch_ratio) / batch_ratio WHEN speed_ratio > 0 THEN 1 ELSE 0 END AS divergence FROM j)
            SELECT *, divergence <= 0.05 AS within FROM d""",
        "rebuffering_pivot": f"WITH {SPEED}, r AS (SELECT window_start, cdn, {_RATIO} AS x FROM speed GROUP BY 1, 2) SELECT window_start, " + ", ".join(f"avg(x) FILTER (cdn = 'cdn-{c}') AS cdn_{c}" for c in "abcd") + " FROM r GROUP BY 1",
    }
