"""Independent DuckDB SQL for every registered query.

These read the base tables directly (no JSON round trip): a message is an
event with its document, if any, a detection is an embedding row.  Parameters
match ``chanmart.plans.registered``.
"""

from __future__ import annotations

from chanmart.plans import registered as Q

_BASE = f"""
messages AS (
  SELECT event_id AS doc_id, ts, user_id, event_type, text, n_chars,
         coalesce(source, concat('src', user_id % 20)) AS source
  FROM events LEFT JOIN documents ON doc_id = event_id
),
stg AS (
  SELECT doc_id AS message_id,
         1000 + CAST(substr(source, 4) AS BIGINT) AS channel_id,
         date_trunc('second', ts) AS message_posted_at,
         text AS message_text,
         CAST(n_chars AS INT) AS view_count,
         CASE WHEN event_type <> 'error' THEN user_id END AS sender_user_id,
         CASE WHEN event_type IN ('view', 'purchase') THEN true
              WHEN event_type = 'click' THEN false END AS has_photo
  FROM messages
  WHERE doc_id <> 0
),
first_day AS (SELECT min(CAST(message_posted_at AS DATE)) AS d0 FROM stg),
spine AS (SELECT CAST(d0 + CAST(a AS INT) AS DATE) AS d FROM first_day, range(0, 1826) t(a)),
dd AS (
  SELECT d AS date_day,
         CAST(extract(year FROM d) AS INT) AS year,
         CAST(extract(month FROM d) AS INT) AS month,
         CAST(extract(day FROM d) AS INT) AS day,
         CAST(extract(dow FROM d) AS INT) AS day_of_week,
         rpad(dayname(d), 9, ' ') AS day_name,
         rpad(monthname(d), 9, ' ') AS month_name,
         CAST(extract(week FROM d) AS INT) AS week_of_year,
         CAST(extract(quarter FROM d) AS INT) AS quarter_of_year
  FROM spine WHERE d <= DATE '{Q.AS_OF}'
),
fct AS (
  SELECT message_id, channel_id, date_day, message_text,
         CAST(length(message_text) AS INT) AS message_length,
         view_count, has_photo, message_posted_at
  FROM stg LEFT JOIN dd ON CAST(message_posted_at AS DATE) = date_day
),
dch AS (
  SELECT DISTINCT channel_id, 'Channel ' || CAST(channel_id AS VARCHAR) AS channel_name
  FROM stg WHERE channel_id IS NOT NULL
),
sdet AS (
  SELECT vec_id + 1 AS detection_id, vec_id // 2 AS message_id,
         concat('images/', vec_id // 2, '.jpg') AS image_path,
         concat('class_', label) AS detected_object_class,
         CAST(abs(embedding[1]) AS FLOAT) AS confidence_score,
         list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE)) AS bounding_box
  FROM embeddings
),
fdet AS (
  SELECT d.detection_id, d.message_id, m.channel_id, m.date_day, d.detected_object_class,
         d.confidence_score, d.bounding_box, d.image_path
  FROM sdet d LEFT JOIN fct m ON d.message_id = m.message_id
),
files AS (
  SELECT concat('telegram_messages/', substr(CAST(ts AS VARCHAR), 1, 10), '/', source, '/', doc_id, '.json')
           AS file_path,
         doc_id, 1000 + CAST(substr(source, 4) AS BIGINT) AS channel_id, ts, event_type
  FROM messages
)
"""


def _q(body: str) -> str:
    return "WITH" + _BASE + body


# Fixed value: the words never counted as a product mention.
STOP = "('and', 'the', 'for', 'with', 'http', 'https', 't.me')"

ORACLE_SQL = {
    "stg_messages": _q("SELECT * FROM stg"),
    "json_reject_missing_id": _q(
        "SELECT file_path, 'missing_id' AS reject_reason FROM files WHERE doc_id = 0"
    ),
    "dim_channels": _q("SELECT * FROM dch"),
    "dim_dates": _q("SELECT * FROM dd"),
    "fct_messages": _q("SELECT * FROM fct"),
    "stg_detections": _q(
        "SELECT detection_id, message_id, image_path, detected_object_class, "
        "CAST(confidence_score AS DOUBLE) AS confidence_score, bounding_box FROM sdet"
    ),
    "fct_image_detections": _q(
        "SELECT detection_id, message_id, channel_id, date_day, detected_object_class, "
        "CAST(confidence_score AS DOUBLE) AS confidence_score, bounding_box, image_path FROM fdet"
    ),
    "dim_dates_full": _q("SELECT * FROM dd").replace(f"DATE '{Q.AS_OF}'", f"DATE '{Q.AS_OF_FULL}'"),
    "json_reject_reasons": _q(
        ", planted AS (SELECT file_path, CASE doc_id % 12 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'not_object' "
        "WHEN 3 THEN 'bad_peer' WHEN 4 THEN 'missing_id' WHEN 5 THEN 'bad_id' WHEN 6 THEN 'bad_channel' "
        "WHEN 7 THEN 'nul_char' WHEN 8 THEN 'lone_surrogate' WHEN 9 THEN 'bad_json' "
        "ELSE CASE WHEN doc_id = 0 THEN 'missing_id' END END AS reject_reason FROM files) "
        "SELECT * FROM planted WHERE reject_reason IS NOT NULL"
    ),
    "filter_channels": _q(
        f"SELECT message_id, channel_id, 'list' AS allowed_by FROM stg WHERE channel_id IN {Q.ALLOWED_CHANNELS} "
        "UNION ALL SELECT message_id, channel_id, 'frame' FROM stg WHERE channel_id IN "
        "(SELECT 1000 + n_nationkey FROM nation WHERE n_regionkey = 1)"
    ),
    "image_message_id": _q(
        "SELECT concat('images/', substr(CAST(ts AS VARCHAR), 1, 10), '/', CASE WHEN doc_id % 7 = 3 THEN 'cover_' ELSE '' END, "
        "doc_id, '.jpg') AS image_path, CASE WHEN doc_id % 7 <> 3 THEN doc_id END AS message_id "
        "FROM files WHERE event_type IN ('view', 'purchase')"
    ),
    "search_messages_wildcard": _q(
        "SELECT message_id, message_text, channel_id, message_posted_at FROM fct "
        "WHERE message_text ILIKE '%t_e%ar%' "
        "ORDER BY message_posted_at DESC NULLS FIRST, message_id LIMIT 100"
    ),
    "search_messages": _q(
        "SELECT message_id, message_text, channel_id, message_posted_at FROM fct "
        f"WHERE message_text ILIKE '%{Q.SEARCH_TERM}%' "
        "ORDER BY message_posted_at DESC NULLS FIRST, message_id LIMIT 100"
    ),
    "top_products": _q(
        ", words AS (SELECT unnest(regexp_split_to_array(lower(message_text), '\\s+')) AS word "
        "FROM fct WHERE message_text IS NOT NULL) "
        "SELECT word AS product_name, COUNT(*) AS mention_count FROM words "
        f"WHERE length(word) > 3 AND word NOT IN {STOP} "
        "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    ),
    "product_mentions": _q(
        ", words AS (SELECT unnest(regexp_split_to_array(lower(message_text), '\\s+')) AS word "
        "FROM fct WHERE message_text IS NOT NULL) "
        "SELECT word AS product_name, COUNT(*) AS mention_count FROM words "
        f"WHERE length(word) > 3 AND word NOT IN {STOP} GROUP BY 1"
    ),
    "channel_activity": _q(
        "SELECT CAST(CAST(message_posted_at AS DATE) AS VARCHAR) AS post_date, "
        f"COUNT(message_id) AS post_count FROM fct WHERE channel_id = {Q.CHANNEL_ID} GROUP BY 1 ORDER BY 1"
    ),
    "channel_activity_by_name": _q(
        "SELECT CAST(CAST(message_posted_at AS DATE) AS VARCHAR) AS post_date, "
        "COUNT(message_id) AS post_count FROM fct WHERE channel_id = "
        f"(SELECT channel_id FROM dch WHERE channel_name = '{Q.CHANNEL_NAME}' LIMIT 1) GROUP BY 1 ORDER BY 1"
    ),
    "channel_id_by_name": _q(f"SELECT channel_id FROM dch WHERE channel_name = '{Q.CHANNEL_NAME}' LIMIT 1"),
    "top_detected_objects": _q(
        "SELECT detected_object_class AS object_class, COUNT(detection_id) AS detection_count "
        "FROM fdet GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    ),
    "latest_per_channel": _q(
        "SELECT channel_id, message_id, message_posted_at FROM ("
        "SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY message_id DESC) AS rn FROM stg) "
        f"WHERE rn <= {Q.LATEST_N}"
    ),
    "photo_worklist": _q(
        ", photos AS (SELECT concat('images/', CAST(CAST(message_posted_at AS DATE) AS VARCHAR), '/', "
        "message_id, '.jpg') AS image_path, message_id, channel_id, message_posted_at FROM stg WHERE has_photo) "
        "SELECT image_path, min(message_id) AS message_id, min(channel_id) AS channel_id FROM photos p "
        "WHERE channel_id IN (SELECT channel_id FROM dch) AND NOT EXISTS (SELECT 1 FROM photos s "
        f"WHERE s.message_posted_at < TIMESTAMP '{Q.IMAGES_STORED_BEFORE}' AND s.image_path = p.image_path) "
        "GROUP BY image_path"
    ),
    "append_new_messages": _q(
        "SELECT file_path, doc_id AS message_id, channel_id FROM files "
        f"WHERE doc_id <> 0 AND CAST(ts AS DATE) >= DATE '{Q.PREVIOUS_RUN_BEFORE}'"
    ),
    "append_new_detections": _q(
        f", existing AS (SELECT * FROM sdet WHERE detected_object_class < '{Q.PREVIOUS_DETECTOR_CLASSES_BELOW}'), "
        "incoming AS (SELECT * FROM sdet UNION ALL SELECT * FROM sdet "
        f"WHERE detected_object_class >= '{Q.REPEATED_CLASSES_FROM}') "
        "SELECT DISTINCT detection_id AS id, message_id, image_path, detected_object_class, "
        "CAST(confidence_score AS DOUBLE) AS confidence_score, bounding_box FROM incoming n "
        "WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.image_path = n.image_path "
        "AND e.detected_object_class = n.detected_object_class AND e.bounding_box = n.bounding_box)"
    ),
    "unprocessed_images": _q(
        "SELECT concat('images/', doc_id, '.jpg') AS path FROM files "
        "WHERE event_type IN ('view', 'purchase') "
        "AND concat('images/', doc_id, '.jpg') NOT IN (SELECT image_path FROM sdet)"
    ),
    "check_unique": _q(
        "SELECT message_id, COUNT(*) AS n_records FROM fdet WHERE message_id IS NOT NULL "
        "GROUP BY message_id HAVING COUNT(*) > 1"
    ),
    "check_not_null": _q("SELECT message_id, channel_id, message_posted_at FROM fct WHERE date_day IS NULL"),
    "check_relationship": _q(
        "SELECT detection_id, message_id FROM fdet d WHERE message_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM fct m WHERE m.message_id = d.message_id)"
    ),
    "run_checks": _q(
        ", r AS ("
        "SELECT 'fct_messages' AS table_name, 'message_id' AS column_name, 'unique' AS check_name, "
        "(SELECT COUNT(*) FROM (SELECT message_id FROM fct WHERE message_id IS NOT NULL "
        "GROUP BY 1 HAVING COUNT(*) > 1)) AS failures "
        "UNION ALL SELECT 'fct_messages', 'message_id', 'not_null', "
        "(SELECT COUNT(*) FROM fct WHERE message_id IS NULL) "
        "UNION ALL SELECT 'fct_messages', 'channel_id', 'not_null', "
        "(SELECT COUNT(*) FROM fct WHERE channel_id IS NULL) "
        "UNION ALL SELECT 'fct_messages', 'channel_id', 'relationships', "
        "(SELECT COUNT(*) FROM fct f WHERE channel_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM dch c WHERE c.channel_id = f.channel_id)) "
        "UNION ALL SELECT 'dim_channels', 'channel_id', 'unique', "
        "(SELECT COUNT(*) FROM (SELECT channel_id FROM dch WHERE channel_id IS NOT NULL "
        "GROUP BY 1 HAVING COUNT(*) > 1)) "
        "UNION ALL SELECT 'dim_channels', 'channel_id', 'not_null', "
        "(SELECT COUNT(*) FROM dch WHERE channel_id IS NULL) "
        "UNION ALL SELECT 'fct_image_detections', 'detection_id', 'unique', "
        "(SELECT COUNT(*) FROM (SELECT detection_id FROM fdet WHERE detection_id IS NOT NULL "
        "GROUP BY 1 HAVING COUNT(*) > 1)) "
        "UNION ALL SELECT 'fct_image_detections', 'detection_id', 'not_null', "
        "(SELECT COUNT(*) FROM fdet WHERE detection_id IS NULL) "
        "UNION ALL SELECT 'fct_image_detections', 'message_id', 'not_null', "
        "(SELECT COUNT(*) FROM fdet WHERE message_id IS NULL) "
        "UNION ALL SELECT 'fct_image_detections', 'message_id', 'relationships', "
        "(SELECT COUNT(*) FROM fdet d WHERE message_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM fct m WHERE m.message_id = d.message_id))) "
        "SELECT table_name, column_name, check_name, CAST(failures AS BIGINT) AS failures, "
        "failures = 0 AS passed FROM r"
    ),
    "ingest_stats": _q(
        "SELECT CAST(COUNT(*) AS BIGINT) AS files_seen, "
        f"CAST(COUNT(*) FILTER (WHERE doc_id <> 0 AND CAST(ts AS DATE) >= DATE '{Q.PREVIOUS_RUN_BEFORE}') AS BIGINT) AS loaded, "
        f"CAST(COUNT(*) FILTER (WHERE doc_id <> 0 AND CAST(ts AS DATE) < DATE '{Q.PREVIOUS_RUN_BEFORE}') AS BIGINT) "
        "AS already_loaded, "
        "CAST(COUNT(*) FILTER (WHERE doc_id = 0) AS BIGINT) AS rejected FROM files"
    ),
    "enrich_images": _q(
        "SELECT DISTINCT doc_id AS message_id, concat('class_', label) AS detected_object_class, "
        "CAST(CAST(abs(CAST(floor(CAST(embedding[1] AS DOUBLE) * 1000) AS BIGINT)) % 1000 / 1000.0 AS FLOAT) AS DOUBLE) AS confidence_score, "
        "list_transform(embedding[2:5], lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS DOUBLE)) AS bounding_box "
        f"FROM embeddings JOIN messages ON doc_id = vec_id // 2 WHERE event_type IN ('view', 'purchase') AND doc_id % {Q.SPOILT_EVERY} <> 3"
    ),
    "land_and_load": _q("SELECT file_path, doc_id AS message_id, channel_id FROM files WHERE doc_id <> 0"),
    "stream_load": _q("SELECT file_path, doc_id AS message_id, channel_id, substr(CAST(ts AS VARCHAR), 1, 10) AS lake_date FROM files WHERE doc_id <> 0"),
    "search_messages_indexed": _q(
        "SELECT message_id, message_text, channel_id, message_posted_at FROM fct "
        f"WHERE message_text ILIKE '%{Q.RARE_TERM}%' "
        "ORDER BY message_posted_at DESC NULLS FIRST, message_id LIMIT 100"
    ),
}

# The rollup forms answer the same questions from partial counts.
ORACLE_SQL["top_products_rollup"] = ORACLE_SQL["top_products"]
ORACLE_SQL["channel_activity_rollup"] = ORACLE_SQL["channel_activity"]
ORACLE_SQL["fct_image_detections_incremental"] = ORACLE_SQL["fct_image_detections"]
ORACLE_SQL["run_checks_incremental"] = ORACLE_SQL["run_checks"]
ORACLE_SQL["top_products_bounded"] = ORACLE_SQL["top_products"]
