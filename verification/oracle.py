"""What each registered query must return, as SQL over the given tables."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%SZ'"
PERIOD_START = "2024-01-08T06:30:00Z"
MIDDLE = "2024-01-16T12:30:00Z"

ADS = """
ads AS (
  SELECT 'ad_' || c_custkey AS ad_id, 'camp_' || c_nationkey AS campaign_id,
         'adv_' || n_regionkey AS advertiser_id,
         'https://example.com/' || c_custkey AS destination_url,
         c_acctbal >= 0 AS active, '2024-01-01T00:00:00Z' AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

TIMED = """
timed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type,
         date_trunc('second', ts) AS clicked_at,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

CLICKS = f"""{ADS}, {TIMED},
clicks AS (
  SELECT event_id, 'imp_' || user_id || '_' || k AS impression_id, ads.ad_id, campaign_id,
         advertiser_id, strftime(clicked_at, {ISO}) AS click_ts,
         strftime(date_trunc('minute', clicked_at), {ISO}) AS minute_bucket,
         strftime(clicked_at + to_seconds(k), {ISO}) AS ingest_ts,
         strftime(clicked_at, '%Y-%m-%d') AS dt, strftime(clicked_at, '%H') AS hr
  FROM timed JOIN ads ON ads.ad_id = 'ad_' || user_id
  WHERE event_type = 'click')"""


def recomputed(where: str = "TRUE", order: str = "ASC", rows: str = "clicks") -> str:
    return f"""
  SELECT campaign_id, minute_bucket, count(*) AS click_count
  FROM (SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY
               ingest_ts {order}, minute_bucket {order}, campaign_id {order}) AS rn
        FROM {rows} WHERE {where})
  WHERE rn = 1 GROUP BY ALL"""


def between(start: str, end: str) -> str:
    return f"minute_bucket >= '{start}' AND minute_bucket < '{end}'"


BATCH_WHERE = between("2023-12-31T00:00:00Z", MIDDLE)
PERIOD_WHERE = between(PERIOD_START, MIDDLE)

STREAM = """
stream AS (
  SELECT campaign_id, minute_bucket, count(*) AS click_count, 'stream' AS source
  FROM clicks GROUP BY ALL)"""

STORED = f"""{CLICKS}, {STREAM},
stored AS (
  SELECT * FROM stream WHERE NOT ({BATCH_WHERE})
  UNION ALL
  SELECT *, 'batch' FROM ({recomputed(BATCH_WHERE)}))"""

REQUESTS = f"""{ADS}, {TIMED},
requests AS (
  SELECT event_id AS request_id,
         CASE event_type WHEN 'error' THEN 'ad_x' || user_id
              WHEN 'signup' THEN ' ad_' || user_id || chr(9)
              ELSE 'ad_' || user_id END AS ad_id,
         CASE WHEN event_type = 'view' AND k % 2 = 0 THEN NULL
              WHEN event_type = 'view' THEN '  '
              WHEN event_type = 'signup' THEN 'simp_' || user_id || '_' || k
              ELSE 'imp_' || user_id || '_' || k END AS impression_id,
         CASE WHEN event_type = 'purchase' THEN 'not-a-time'
              WHEN event_type = 'signup' THEN NULL
              ELSE strftime(clicked_at, {ISO}) END AS click_ts,
         clicked_at + to_seconds(k) AS received_at
  FROM timed)"""

JUDGED = f"""{REQUESTS},
cleaned AS (
  SELECT request_id, nullif(trim(ad_id, chr(9) || chr(10) || chr(13) || ' '), '') AS ad_id,
         nullif(trim(impression_id, chr(9) || chr(10) || chr(13) || ' '), '') AS impression_id,
         CASE WHEN click_ts IS NULL THEN received_at ELSE try_cast(click_ts AS TIMESTAMP) END
           AS clicked_at,
         received_at, CAST(epoch(received_at) AS BIGINT) AS arrival
  FROM requests),
judged AS (
  SELECT c.*, a.campaign_id, a.advertiser_id, a.destination_url,
         CASE WHEN c.ad_id IS NULL OR impression_id IS NULL THEN 'missing_parameter'
              WHEN active IS DISTINCT FROM TRUE THEN 'unknown_ad'
              WHEN clicked_at IS NULL THEN 'bad_timestamp' END AS reason
  FROM cleaned c LEFT JOIN ads a ON c.ad_id = a.ad_id)"""

CHAIN = """
chain AS (
  SELECT impression_id, min(arrival) AS arrival FROM valid GROUP BY impression_id
  UNION ALL
  SELECT v.impression_id, min(v.arrival) AS arrival
  FROM chain c JOIN valid v
    ON v.impression_id = c.impression_id AND v.arrival >= c.arrival + 172800
  GROUP BY v.impression_id)"""

ACCEPTED = f"""{JUDGED},
valid AS (SELECT * FROM judged WHERE reason IS NULL), {CHAIN},
accepted AS (
  SELECT v.*, row_number() OVER (PARTITION BY impression_id, arrival
                                 ORDER BY clicked_at, request_id) AS rn
  FROM valid v JOIN chain USING (impression_id, arrival) QUALIFY rn = 1)"""

EVENTS = f"""{ACCEPTED},
captured AS (
  SELECT sha256(request_id || '|' || impression_id || '|' || ad_id) AS event_id, impression_id,
         ad_id, campaign_id, advertiser_id, strftime(clicked_at, {ISO}) AS click_ts,
         strftime(date_trunc('minute', clicked_at), {ISO}) AS minute_bucket,
         strftime(received_at, {ISO}) AS ingest_ts
  FROM accepted)"""

OUTCOMES = f"""{EVENTS},
outcomes AS (
  SELECT j.request_id, j.ad_id, j.impression_id,
         CASE WHEN reason IS NULL THEN 302 WHEN reason = 'unknown_ad' THEN 404 ELSE 400 END
           AS status,
         reason, a.request_id IS NOT NULL AS emitted,
         CASE WHEN reason IS NULL THEN destination_url END AS location
  FROM judged j LEFT JOIN (SELECT request_id FROM accepted) a USING (request_id))"""

# Some requests dated seven years ahead, some of impressions of their own that come weeks late.
UNTIMELY = OUTCOMES.replace(
    """
cleaned AS (
  SELECT""",
    """
changed AS (
  SELECT request_id, ad_id, click_ts, delivery,
         CASE WHEN delivery = 3 THEN impression_id || '_late' ELSE impression_id END AS impression_id,
         CASE WHEN CAST(request_id AS BIGINT) % 31 = 3 THEN received_at + INTERVAL 7 YEAR ELSE received_at END AS received_at
  FROM (SELECT *, CASE WHEN CAST(request_id AS BIGINT) % 40 = 7 AND CAST(request_id AS BIGINT) % 31 <> 3
                        AND received_at < TIMESTAMP '2024-01-10' THEN 3 ELSE 1 END AS delivery
        FROM requests)),
cleaned AS (
  SELECT""",
).replace("  FROM requests),\njudged", "  FROM changed),\njudged")

FLAWED = f"""{CLICKS},
flawed AS (
  SELECT event_id, ad_id, advertiser_id, ingest_ts, ingest_ts[19] AS digit,
         CASE ingest_ts[19] WHEN '7' THEN 'soon' ELSE click_ts END AS click_ts,
         CASE ingest_ts[19] WHEN '0' THEN NULL WHEN '1' THEN '' ELSE impression_id END
           AS impression_id,
         CASE ingest_ts[19] WHEN '2' THEN minute_bucket[1:17] || '42Z' ELSE minute_bucket END
           AS minute_bucket,
         CASE WHEN ingest_ts[19] IN ('1', '3') THEN NULL ELSE campaign_id END AS campaign_id
  FROM clicks)"""

ASKED = f"""
asked AS (
  SELECT 'req_' || c_custkey AS request_id,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN 'Basic adv_1'
              ELSE 'Bearer adv_' ||
                   (n_regionkey + CASE WHEN c_custkey % 19 = 0 THEN 1 ELSE 0 END)
         END AS auth,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'camp_' || c_nationkey END AS campaign_id,
         TIMESTAMP '2024-01-01' + to_seconds(c_custkey * 7919 % (29 * 86400)) AS start,
         CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE
         TIMESTAMP '2024-01-01' + to_seconds(c_custkey * 7919 % (29 * 86400) +
           CASE WHEN c_custkey % 17 = 0 THEN 30 * 86400
                WHEN c_mktsegment = 'MACHINERY' THEN 9 * 86400 + 3600 * 5
                WHEN c_mktsegment = 'HOUSEHOLD' THEN 86400 + 1234
                ELSE 7200 + 30 END) END AS stop,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'day'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN 'hour'
              WHEN c_mktsegment = 'BUILDING' THEN 'minute'
              WHEN c_mktsegment = 'AUTOMOBILE' AND c_custkey % 2 = 0 THEN 'weekly'
              ELSE 'minute' END AS requested
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
spoken AS (
  SELECT *, CASE WHEN starts_with(auth, 'Bearer ') THEN auth[8:] END
              AS advertiser_id
  FROM asked),
pairs AS (SELECT DISTINCT advertiser_id, campaign_id FROM ads)"""


def buckets(unit: str, seconds: int) -> str:
    return (
        f"CAST(ceil((epoch(stop) - epoch(date_trunc('{unit}', start))) / {seconds}) AS BIGINT)"
    )


MINUTES, HOURS, DAYS = buckets("minute", 60), buckets("hour", 3600), buckets("day", 86400)
OF_HOUR = f"CASE WHEN {HOURS} <= 1500 THEN 'hour' ELSE 'day' END"
OF_MINUTE = f"CASE WHEN {MINUTES} <= 1500 THEN 'minute' ELSE {OF_HOUR} END"

ANSWERED = f"""{ASKED},
answered AS (
  SELECT *, CASE requested WHEN 'minute' THEN {OF_MINUTE} WHEN 'hour' THEN {OF_HOUR}
                           ELSE 'day' END AS fitted
  FROM (SELECT s.*, CASE WHEN s.advertiser_id IS NULL THEN 'unauthenticated'
                    WHEN s.campaign_id IS NULL THEN 'missing_parameter'
                    WHEN requested NOT IN ('minute', 'hour', 'day') THEN 'bad_granularity'
                    WHEN stop IS NULL OR stop <= start THEN 'bad_range'
                    WHEN p.campaign_id IS NULL THEN 'forbidden' END AS reason
        FROM spoken s LEFT JOIN pairs p
          ON s.advertiser_id = p.advertiser_id AND s.campaign_id = p.campaign_id)),
statuses AS (
  SELECT *, CASE reason WHEN 'unauthenticated' THEN 401 WHEN 'forbidden' THEN 403
                        WHEN 'missing_parameter' THEN 400 WHEN 'bad_granularity' THEN 400
                        WHEN 'bad_range' THEN 400 ELSE 200 END AS status,
         CASE WHEN reason IS NULL THEN fitted END AS granularity
  FROM answered)"""


def series(source: str) -> str:
    return f"""{STORED}, {ANSWERED},
buckets AS (
  SELECT request_id, campaign_id, granularity, start, stop,
         unnest(CASE granularity
           WHEN 'minute' THEN range(date_trunc('minute', start), stop, INTERVAL 1 MINUTE)
           WHEN 'hour' THEN range(date_trunc('hour', start), stop, INTERVAL 1 HOUR)
           ELSE range(date_trunc('day', start), stop, INTERVAL 1 DAY) END) AS bucket
  FROM statuses WHERE status = 200),
timed_rows AS (
  SELECT campaign_id, click_count, source, CAST(minute_bucket[1:19] AS TIMESTAMP) AS minute
  FROM stored),
sums AS (
  SELECT s.request_id,
         CASE s.granularity WHEN 'minute' THEN date_trunc('minute', minute)
              WHEN 'hour' THEN date_trunc('hour', minute)
              ELSE date_trunc('day', minute) END AS bucket,
         CAST(sum(click_count) AS BIGINT) AS click_count, {source} AS source
  FROM statuses s JOIN timed_rows t ON t.campaign_id = s.campaign_id
   AND minute >= s.start AND minute < s.stop
  WHERE s.status = 200 GROUP BY 1, 2),
series AS (
  SELECT request_id, campaign_id, granularity, strftime(bucket, {ISO}) AS bucket_start,
         coalesce(click_count, 0) AS click_count, coalesce(source, 'stream') AS source
  FROM buckets LEFT JOIN sums USING (request_id, bucket))"""


EXACT_SOURCE = "CASE WHEN bool_and(source = 'batch') THEN 'batch' ELSE 'stream' END"


def rollup(unit: str, source: str) -> str:
    return f"""WITH {STORED}
SELECT campaign_id,
       strftime(date_trunc('{unit}', CAST(minute_bucket[1:19] AS TIMESTAMP)), {ISO})
         AS bucket_start,
       CAST(sum(click_count) AS BIGINT) AS click_count, {source} AS source
FROM stored GROUP BY 1, 2"""


def upsert(protect: bool) -> str:
    guard = "AND o.source <> 'batch'" if protect else ""
    return f"""WITH {STORED},
old AS (SELECT * FROM stored),
new AS (SELECT CASE WHEN campaign_id = 'camp_1' THEN 'camp_1_new' ELSE campaign_id END AS campaign_id,
               minute_bucket, click_count, 'stream' AS source FROM ({recomputed()}))
SELECT campaign_id, minute_bucket,
       CASE WHEN n.source IS NOT NULL AND (o.source IS NULL OR (TRUE {guard}))
            THEN n.click_count ELSE o.click_count END AS click_count,
       CASE WHEN n.source IS NOT NULL AND (o.source IS NULL OR (TRUE {guard}))
            THEN n.source ELSE o.source END AS source
FROM old o FULL JOIN new n USING (campaign_id, minute_bucket)"""


SWAPPED = f"""WITH {CLICKS}, {STREAM}
SELECT * FROM stream WHERE NOT ({PERIOD_WHERE})
UNION ALL
SELECT *, 'batch' FROM ({recomputed(PERIOD_WHERE)})"""

CLOSED = f"""WITH {CLICKS}, {STREAM},
latest AS (SELECT max(CAST(click_ts[1:19] AS TIMESTAMP)) AS seen FROM clicks)
SELECT stream.* FROM stream, latest
WHERE CAST(minute_bucket[1:19] AS TIMESTAMP) + INTERVAL 1 MINUTE <= seen - INTERVAL 30 SECOND"""


def seconds(text: str) -> str:
    return f"epoch(CAST({text}[1:19] AS TIMESTAMP))"


CAPTURE_DELAY = f"{seconds('ingest_ts')} - {seconds('click_ts')}"


def percentile(by: str, delay: str) -> str:
    partition = f"PARTITION BY {by}" if by else ""
    column = f"{by}," if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH {CLICKS},
delays AS (SELECT campaign_id, CAST({delay} AS BIGINT) AS delay FROM clicks),
ranked AS (
  SELECT *, row_number() OVER ({partition} ORDER BY delay) AS rn,
         count(*) OVER ({partition}) AS n
  FROM delays)
SELECT {column} count(*) AS samples,
       min(CASE WHEN rn = floor(n * CAST(0.95 AS DOUBLE)) THEN delay END) AS percentile,
       max(delay) AS largest
FROM ranked {group}"""


REQUIRED = (
    "event_id",
    "impression_id",
    "ad_id",
    "campaign_id",
    "advertiser_id",
    "click_ts",
    "minute_bucket",
    "ingest_ts",
)
GOOD_BUCKET = r"'\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:00Z'"


def _joined(*cases: str) -> str:
    ends = ", ".join(f"CASE WHEN {test} THEN '{finding}' END" for test, finding in cases)
    return f"concat_ws('; ', {ends})"


VIOLATIONS = _joined(
    *[(f"coalesce({name}, '') = ''", f"{name} is required") for name in REQUIRED],
    (f"NOT regexp_full_match(minute_bucket, {GOOD_BUCKET})", "minute_bucket is malformed"),
)
SCHEMA_VIOLATIONS = _joined(
    ("digit = '5'", "unknown field referrer"),
    *[(f"{name} IS NULL", f"{name} is missing") for name in REQUIRED],
    ("digit = '6'", "user_agent is not text"),
    *[
        (f"{name} = ''", f"{name} is empty")
        for name in ("impression_id", "ad_id", "campaign_id", "advertiser_id")
    ],
    (f"NOT regexp_full_match(minute_bucket, {GOOD_BUCKET})", "minute_bucket is malformed"),
    ("digit = '7'", "click_ts is no date-time"),
)


def json_object(*names: str) -> str:
    pairs = " || ',' || ".join(f"'\"{name}\":\"' || {name} || '\"'" for name in names)
    return f"'{{' || {pairs} || '}}'"


SHIPMENTS = f"""
lines AS (
  SELECT 'imp_' || l_orderkey || '_' || l_linenumber AS impression_id,
         'camp_' || l_suppkey AS campaign_id,
         strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER)), {ISO}) AS minute_bucket,
         strftime(l_shipdate + to_minutes(CAST(l_partkey % 1440 AS INTEGER))
                  + to_seconds(l_partkey % 100), {ISO}) AS ingest_ts
  FROM lineitem)"""

EVENT_COLUMNS = (
    "event_id, impression_id, ad_id, campaign_id, advertiser_id, click_ts, minute_bucket, ingest_ts"
)
READABLE = f"WITH {ADS}, {ASKED}"

ARCHIVE_ERRORS = f"""WITH {CLICKS}
SELECT CASE ingest_ts[19] WHEN '4' THEN 'malformed_json' ELSE 'invalid_event' END AS error_type,
       '2024-01-31' AS dt, count(*) AS records
FROM clicks WHERE ingest_ts[19] IN ('0', '4') GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "recompute_minute": f"WITH {CLICKS} {recomputed()}",
    "recompute_shipments": f"WITH {SHIPMENTS} {recomputed(rows='lines')}",
    "recompute_salted": f"WITH {CLICKS} {recomputed()}",
    "recompute_keep_last": f"WITH {CLICKS} {recomputed(order='DESC')}",
    "surviving_clicks": f"""WITH {CLICKS}
SELECT {EVENT_COLUMNS}, dt, hr FROM clicks
QUALIFY row_number() OVER (PARTITION BY impression_id ORDER BY ingest_ts, click_ts, event_id) = 1""",
    "ground_truth_distinct": f"""WITH {CLICKS}
SELECT campaign_id, minute_bucket, count(DISTINCT impression_id) AS exact
FROM clicks GROUP BY ALL""",
    "period_scan": f"""WITH {CLICKS}
SELECT event_id, campaign_id, minute_bucket, dt, hr FROM clicks WHERE {PERIOD_WHERE}""",
    "minute_floor": f"""SELECT event_id, strftime(date_trunc('minute', ts), {ISO}) AS minute_bucket
FROM events""",
    "bucket_valid": f"""WITH {REQUESTS}
SELECT request_id, click_ts,
       coalesce(regexp_full_match(click_ts, {GOOD_BUCKET}), FALSE) AS valid
FROM requests""",
    "capture_outcomes": f"WITH RECURSIVE {OUTCOMES} SELECT * FROM outcomes",
    "capture_events": f"WITH RECURSIVE {EVENTS} SELECT * FROM captured",
    "stream_capture_events": f"WITH RECURSIVE {EVENTS} SELECT * FROM captured",
    "stream_outcomes": f"WITH RECURSIVE {OUTCOMES} SELECT * FROM outcomes",
    "stream_untimely_events": f"WITH RECURSIVE {UNTIMELY} SELECT * FROM captured",
    "stream_untimely_outcomes": f"WITH RECURSIVE {UNTIMELY} SELECT * FROM outcomes",
    "stream_set_aside": f"""WITH RECURSIVE {UNTIMELY}
SELECT request_id, impression_id, CASE WHEN received_at > TIMESTAMP '2024-02-06' THEN 'ahead' ELSE 'behind' END AS kind
FROM valid JOIN (SELECT request_id FROM changed WHERE delivery = 3 OR received_at > TIMESTAMP '2024-02-06') USING (request_id)""",
    "stream_catalog_change": "WITH RECURSIVE "
    + OUTCOMES.replace(
        "active IS DISTINCT FROM TRUE", "active IS DISTINCT FROM TRUE OR (received_at >= TIMESTAMP '2024-01-20' AND a.campaign_id = 'camp_3')"
    ).replace(
        "a.destination_url,",
        "CASE WHEN received_at >= TIMESTAMP '2024-01-20' AND a.campaign_id = 'camp_5' THEN 'https://example.com/moved' ELSE a.destination_url END AS destination_url,",
    )
    + " SELECT * FROM outcomes",
    "first_click_48h": f"""WITH RECURSIVE {CLICKS},
valid AS (
  SELECT impression_id, event_id, click_ts,
         CAST(epoch(CAST(ingest_ts[1:19] AS TIMESTAMP)) AS BIGINT) AS arrival
  FROM clicks), {CHAIN}
SELECT impression_id, event_id, arrival FROM valid JOIN chain USING (impression_id, arrival)
QUALIFY row_number() OVER (PARTITION BY impression_id, arrival ORDER BY click_ts, event_id) = 1""",
    "rejected_clicks": f"""WITH {CLICKS}
SELECT event_id, ad_id FROM clicks
WHERE NOT EXISTS (SELECT 1 FROM ads WHERE ads.ad_id = clicks.ad_id AND active)""",
    "event_violations": f"""WITH {FLAWED}
SELECT event_id, {VIOLATIONS} AS findings FROM flawed WHERE {VIOLATIONS} <> ''""",
    "schema_violations": f"""WITH {FLAWED}
SELECT event_id, CASE WHEN digit = '4' THEN 'not a JSON object' ELSE {SCHEMA_VIOLATIONS} END
  AS findings
FROM flawed WHERE digit = '4' OR {SCHEMA_VIOLATIONS} <> ''""",
    "event_json": f"""WITH {CLICKS}
SELECT event_id, {json_object(*REQUIRED)} AS event FROM clicks""",
    "catalog_quality": f"""WITH {ADS}
SELECT ad_id, {_joined(("campaign_id = 'camp_7'", "campaign_id is required"),
                       ("NOT active", "destination_url must be absolute https"))} AS findings
FROM ads WHERE campaign_id = 'camp_7' OR NOT active""",
    "catalog_upsert": f"""WITH {ADS}
SELECT ad_id, campaign_id, advertiser_id,
       CASE WHEN campaign_id = 'camp_3' THEN 'https://example.com/closed'
            ELSE destination_url END AS destination_url,
       active AND campaign_id <> 'camp_3' AS active, created_at
FROM ads
UNION ALL
SELECT ad_id || '_b', campaign_id, advertiser_id, 'https://example.com/closed', FALSE, created_at
FROM ads WHERE campaign_id = 'camp_3'""",
    "advertiser_campaigns": f"WITH {ADS} SELECT DISTINCT advertiser_id, campaign_id FROM ads",
    "aggregate_key_unique": f"""WITH {CLICKS}, {STREAM}
SELECT campaign_id, minute_bucket, count(*) AS rows
FROM (SELECT campaign_id, minute_bucket FROM stream
      UNION ALL SELECT campaign_id, minute_bucket FROM ({recomputed()}))
GROUP BY ALL HAVING count(*) > 1""",
    "metrics_judged": f"""WITH {ADS}, {ANSWERED}
SELECT request_id, advertiser_id, status, reason, granularity FROM statuses""",
    "owned_campaigns": f"""{READABLE}
SELECT request_id, s.advertiser_id, s.campaign_id FROM spoken s
WHERE EXISTS (SELECT 1 FROM ads a WHERE a.advertiser_id = s.advertiser_id
              AND a.campaign_id = s.campaign_id)""",
    "denied_requests": f"""{READABLE}
SELECT request_id, s.advertiser_id, coalesce(s.campaign_id, ' ') AS campaign_id FROM spoken s
WHERE NOT EXISTS (SELECT 1 FROM ads a WHERE a.advertiser_id = s.advertiser_id
                  AND a.campaign_id = s.campaign_id)""",
    "effective_granularity": f"""{READABLE}
SELECT request_id, {MINUTES} AS minutes, {HOURS} AS hours, {DAYS} AS days,
       {OF_MINUTE} AS of_minute, {OF_HOUR} AS of_hour, 'day' AS of_day,
       strftime(date_trunc('hour', start), {ISO}) AS hour_floor
FROM spoken WHERE stop > start""",
    "rollup_hour": rollup("hour", EXACT_SOURCE),
    "rollup_day": rollup("day", EXACT_SOURCE),
    "rollup_day_from_hours": rollup("day", EXACT_SOURCE),
    "rollup_min_source": rollup("day", "min(source)"),
    "metrics_series": f"WITH {series(EXACT_SOURCE)} SELECT * FROM series",
    "metrics_series_min_source": f"WITH {series('min(source)')} SELECT * FROM series",
    "metrics_responses": f"""WITH {series(EXACT_SOURCE)},
listed AS (
  SELECT request_id, string_agg('{{"bucket_start":"' || bucket_start || '","click_count":'
           || click_count || ',"source":"' || source || '"}}', ',' ORDER BY bucket_start) AS listed
  FROM series GROUP BY request_id)
SELECT request_id, status,
       CASE WHEN status = 200 THEN '{{"campaign_id":"' || campaign_id || '","granularity":"'
              || granularity || '","from":"' || strftime(start, {ISO}) || '","to":"'
              || strftime(stop, {ISO}) || '","buckets":[' || listed || ']}}'
            ELSE '{{"error":"' || reason || '","detail":"' || CASE reason
              WHEN 'unauthenticated' THEN 'missing bearer token'
              WHEN 'missing_parameter' THEN 'campaign_id is required'
              WHEN 'bad_granularity' THEN 'granularity must be one of minute, hour, day'
              WHEN 'bad_range' THEN 'from/to must be valid ISO8601 with to > from'
              ELSE 'campaign not owned by caller' END || '"}}' END AS body
FROM statuses LEFT JOIN listed USING (request_id)""",
    "campaign_series": f"""WITH {STORED},
hours AS (
  SELECT unnest(range(TIMESTAMP '2024-01-13 05:00:00', TIMESTAMP '2024-01-20 07:45:10',
                      INTERVAL 1 HOUR)) AS hour),
sums AS (
  SELECT date_trunc('hour', CAST(minute_bucket[1:19] AS TIMESTAMP)) AS hour,
         CAST(sum(click_count) AS BIGINT) AS n, {EXACT_SOURCE} AS source
  FROM stored
  WHERE campaign_id = 'camp_3' AND {between("2024-01-13T05:20:30Z", "2024-01-20T07:45:10Z")}
  GROUP BY 1)
SELECT 'camp_3' AS campaign_id, 'hour' AS granularity, strftime(hour, {ISO}) AS bucket_start,
       coalesce(n, 0) AS click_count, coalesce(source, 'stream') AS source
FROM hours LEFT JOIN sums USING (hour)""",
    "upsert_protected": upsert(True),
    "upsert_literal": upsert(False),
    "period_swap": SWAPPED,
    "reconcile_published": SWAPPED,
    "drift_corrected": f"""WITH {CLICKS}, {STREAM}
SELECT campaign_id, minute_bucket,
       click_count + CASE WHEN campaign_id = 'camp_1' THEN 999 ELSE 0 END AS click_count, source
FROM stream WHERE NOT ({PERIOD_WHERE})
UNION ALL
SELECT *, 'batch' FROM ({recomputed(PERIOD_WHERE)})""",
    "outcomes_redelivered": f"""WITH RECURSIVE {OUTCOMES}
SELECT * FROM outcomes
UNION ALL
SELECT * REPLACE (FALSE AS emitted) FROM outcomes""",
    "archive_table_scan": f"""WITH {CLICKS}
SELECT dt, hr, 2 * count(*) AS clicks FROM clicks GROUP BY ALL""",
    "phantom_removed": f"""{SWAPPED}
UNION ALL
SELECT 'ghost_' || campaign_id, minute_bucket, click_count, source FROM stream
WHERE NOT ({PERIOD_WHERE})""",
    "drift_report": f"""WITH {STORED},
wrong AS (
  SELECT campaign_id, minute_bucket, source,
         click_count + CASE WHEN campaign_id = 'camp_1' THEN 999 ELSE 0 END AS click_count
  FROM stored),
truth AS (
  SELECT campaign_id, minute_bucket, count(DISTINCT impression_id) AS exact
  FROM clicks GROUP BY ALL)
SELECT campaign_id, minute_bucket, click_count, source, exact
FROM wrong FULL JOIN truth USING (campaign_id, minute_bucket)
WHERE click_count IS DISTINCT FROM exact""",
    "last_closed_hour": f"""SELECT event_id,
  strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, {ISO}) AS hour_start,
  strftime(date_trunc('hour', ts), {ISO}) AS hour_end,
  strftime(date_trunc('day', ts) - INTERVAL 1 DAY, {ISO}) AS day_start,
  strftime(CAST(date_trunc('day', ts) AS TIMESTAMP), {ISO}) AS day_end
FROM events""",
    "captured_per_day": f"""WITH {CLICKS}
SELECT dt, count(DISTINCT impression_id) AS captured FROM clicks GROUP BY dt""",
    "no_loss_audit": f"""WITH RECURSIVE {OUTCOMES},
sent AS (SELECT DISTINCT impression_id FROM outcomes WHERE status = 302),
kept AS (SELECT DISTINCT impression_id FROM captured)
SELECT (SELECT count(*) FROM sent) AS accepted, (SELECT count(*) FROM kept) AS captured,
       (SELECT count(*) FROM sent ANTI JOIN kept USING (impression_id)) AS lost,
       (SELECT count(*) FROM kept ANTI JOIN sent USING (impression_id)) AS unexpected""",
    "loss_found": f"""WITH RECURSIVE {OUTCOMES},
sent AS (SELECT DISTINCT impression_id FROM outcomes WHERE status = 302),
kept AS (SELECT DISTINCT impression_id FROM captured WHERE campaign_id <> 'camp_1')
SELECT (SELECT count(*) FROM sent) AS accepted, (SELECT count(*) FROM kept) AS captured,
       (SELECT count(*) FROM sent ANTI JOIN kept USING (impression_id)) AS lost,
       (SELECT count(*) FROM kept ANTI JOIN sent USING (impression_id)) AS unexpected""",
    "unmatched_impressions": f"""WITH RECURSIVE {OUTCOMES},
sent AS (SELECT DISTINCT impression_id FROM outcomes WHERE status = 302),
kept AS (SELECT DISTINCT 'imp_' || user_id || '_' || k AS impression_id
         FROM timed JOIN ads ON ad_id = 'ad_' || user_id WHERE event_type = 'click')
SELECT impression_id, 'lost' AS finding FROM sent ANTI JOIN kept USING (impression_id)
UNION ALL
SELECT impression_id, 'unexpected' FROM kept ANTI JOIN sent USING (impression_id)""",
    "outcome_tally": f"""WITH RECURSIVE {OUTCOMES}
SELECT status, reason, emitted, count(*) AS requests FROM outcomes GROUP BY ALL""",
    "hot_ads": f"""WITH {CLICKS}
SELECT ad_id, count(*) AS clicks,
       round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clicks), 9) AS share
FROM clicks GROUP BY ad_id
HAVING CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clicks) >= CAST(0.001 AS DOUBLE)""",
    "freshness_p95": percentile("", CAPTURE_DELAY),
    "freshness_p95_by_campaign": percentile("campaign_id", CAPTURE_DELAY),
    "freshness_visible": f"""WITH {CLICKS},
weekly AS (
  SELECT *, CAST({seconds("minute_bucket")} AS BIGINT) + 60 AS over_at,
         greatest(0, least(4, (CAST(minute_bucket[1:10] AS DATE) - DATE '2023-12-31') // 7)) AS week
  FROM clicks),
seen AS (SELECT week, max({seconds("click_ts")}) OVER (ORDER BY week) - 30 AS mark FROM (SELECT week, max(click_ts) AS click_ts FROM weekly GROUP BY week)),
visible AS (
  SELECT campaign_id, minute_bucket, ingest_ts, min(s.week) AS week
  FROM weekly w JOIN seen s ON s.week >= w.week AND s.mark >= w.over_at
  GROUP BY campaign_id, minute_bucket, ingest_ts, event_id),
delays AS (
  SELECT epoch(CASE WHEN week < 4 THEN TIMESTAMP '2024-01-07' + to_days(CAST(7 * week AS INTEGER)) ELSE TIMESTAMP '2024-02-04' END)
         - {seconds("ingest_ts")} AS delay
  FROM visible),
ranked AS (SELECT CAST(delay AS BIGINT) AS delay, row_number() OVER (ORDER BY delay) AS rn, count(*) OVER () AS n FROM delays)
SELECT count(*) AS samples, min(CASE WHEN rn = floor(n * CAST(0.95 AS DOUBLE)) THEN delay END) AS percentile, max(delay) AS largest
FROM ranked""",
    "delay_outliers_p95": f"""WITH {CLICKS},
far AS (
  SELECT campaign_id, CASE WHEN CAST(event_id AS BIGINT) % 5003 = 11 THEN 1000000000000000
         ELSE CAST({CAPTURE_DELAY} AS BIGINT) * 1000003 + CAST(event_id AS BIGINT) % 997 END AS micros FROM clicks),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY campaign_id ORDER BY micros) AS rn, count(*) OVER (PARTITION BY campaign_id) AS n FROM far)
SELECT campaign_id, count(*) AS samples,
       min(CASE WHEN rn = floor(n * CAST(0.95 AS DOUBLE)) THEN micros END) AS percentile, max(micros) AS largest
FROM ranked GROUP BY campaign_id""",
    "captured_from_sketches": f"""WITH {CLICKS}
SELECT dt, count(*) AS clicks, count(DISTINCT impression_id) AS exact, TRUE AS close FROM clicks GROUP BY dt""",
    "delays_from_sketches": f"WITH {CLICKS} SELECT count(*) AS samples, TRUE AS near FROM clicks",
    "expired_archive": f"WITH {CLICKS} SELECT event_id, dt FROM clicks WHERE dt >= '2024-01-13'",
    "salted_keys": f"WITH {CLICKS} SELECT ad_id, count(*) AS clicks, TRUE AS sound FROM clicks GROUP BY ad_id",
    "reconciled_now": f"SELECT *, TRUE AS recent FROM ({SWAPPED})",
    "lookback_by_index": f"""WITH {CLICKS}
SELECT * FROM ({recomputed(between("2024-01-06T06:30:00Z", MIDDLE))}) WHERE {PERIOD_WHERE}""",
    "stream_out_of_order": CLOSED.replace("INTERVAL 30 SECOND", "INTERVAL 9 DAY"),
    "stream_two_consumers": f"""{CLOSED.replace("INTERVAL 30 SECOND", "INTERVAL 9 DAY").replace("SELECT stream.* FROM stream, latest", "SELECT campaign_id, minute_bucket, click_count AS archived, CASE WHEN CAST(minute_bucket[1:19] AS TIMESTAMP) + INTERVAL 1 MINUTE <= seen - INTERVAL 9 DAY THEN click_count END AS counted FROM stream, latest").split("WHERE CAST(minute_bucket")[0]}""",
    "stream_hot_ads": f"""WITH {CLICKS},
days AS (SELECT dt, count(*) AS total FROM clicks GROUP BY dt),
latest AS (SELECT max(CAST(click_ts[1:19] AS TIMESTAMP)) AS seen FROM clicks)
SELECT dt || 'T00:00:00Z' AS window_start, ad_id, count(*) AS clicks, round(CAST(count(*) AS DOUBLE) / total, 9) AS share
FROM clicks JOIN days USING (dt), latest
WHERE CAST(dt AS TIMESTAMP) + INTERVAL 1 DAY <= seen - INTERVAL 30 SECOND
GROUP BY dt, ad_id, total HAVING CAST(count(*) AS DOUBLE) / total >= CAST(0.02 AS DOUBLE)""",
    "source_mix": f"""WITH {STORED}
SELECT minute_bucket[1:10] AS day, source, count(*) AS rows,
       CAST(sum(click_count) AS BIGINT) AS clicks
FROM stored GROUP BY ALL""",
    "retained_archive": f"WITH {CLICKS} SELECT event_id, dt FROM clicks WHERE dt >= '2024-01-13'",
    "archive_roundtrip": f"""WITH {CLICKS}
SELECT {EVENT_COLUMNS}, dt, hr FROM clicks WHERE {PERIOD_WHERE}""",
    "reconcile_lookback": f"""WITH {CLICKS}
SELECT * FROM ({recomputed(between("2024-01-06T06:30:00Z", MIDDLE))}) WHERE {PERIOD_WHERE}""",
    "stream_minute_counts": CLOSED,
    "stream_replay_idempotent": CLOSED,
    "stream_restart": CLOSED,
    "stream_late_rows": CLOSED,
    "archive_stream": f"""WITH {CLICKS}
SELECT {EVENT_COLUMNS}, dt, hr FROM clicks WHERE ingest_ts[19] NOT IN ('0', '4')""",
    "archive_repeated_batch": f"""WITH {CLICKS}
SELECT {EVENT_COLUMNS}, dt, hr FROM clicks WHERE ingest_ts[19] NOT IN ('0', '4')""",
    "archive_errors": ARCHIVE_ERRORS,
    "archive_repeated_errors": ARCHIVE_ERRORS,
}
