"""SQL over the raw tables with the answers the queries must give."""

from __future__ import annotations

from flowspark.fixtures import FLOW_FEATURES, RULE_LABELS, TEXT_COLUMNS
from flowspark.schema import (
    DEFAULT_CLASS,
    EXCLUDED_CLASS,
    FEATURES,
    LABEL_RULES,
    RARE_CLASSES,
    UNKNOWN_CLASS,
)

RAW_LABEL = """
CASE event_type
  WHEN 'click' THEN 'BENIGN'
  WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 'DoS Hulk' WHEN 1 THEN 'DDoS'
    WHEN 2 THEN 'PortScan' ELSE 'DoS slowloris' END
  WHEN 'error' THEN CASE event_id % 5 WHEN 0 THEN 'Web Attack - XSS'
    WHEN 1 THEN 'Web Attack - Sql Injection' WHEN 2 THEN 'Web Attack - Brute Force'
    WHEN 3 THEN 'FTP-Patator' ELSE 'SSH-Patator' END
  WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'Bot' WHEN 1 THEN 'Infiltration'
    ELSE 'Heartbleed' END
  WHEN 'purchase' THEN CASE event_id % 2 WHEN 0 THEN NULL ELSE 'BENIGN' END
END"""


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_text(v) for v in values)


def _clean(expression: str) -> str:
    number = f"TRY_CAST({expression} AS DOUBLE)"
    return (
        f"CASE WHEN {number} IS NULL OR isnan({number}) OR isinf({number}) "
        f"THEN 0.0e0 ELSE {number} END"
    )


def _cast(names, how) -> str:
    return ", ".join(f'{how(_quoted(n))} AS {_quoted(n)}' for n in names)


def _quoted(name: str) -> str:
    return f'"{name}"'


def _try(expression: str) -> str:
    return f"TRY_CAST({expression} AS DOUBLE)"


CLASS = (
    "CASE "
    + " ".join(f"WHEN \"Label\" LIKE {_text(p)} THEN {_text(c)}" for p, c in LABEL_RULES)
    + f" ELSE {_text(DEFAULT_CLASS)} END"
)
RULE = (
    'CASE WHEN "Flow Duration" < 40 THEN 0.0e0 WHEN "Flow Duration" < 100 THEN 1.0e0 '
    "ELSE 2.0e0 END"
)
RULE_CLASS = (
    f'CASE WHEN "Flow Duration" < 40 THEN {_text(RULE_LABELS[0])} '
    f'WHEN "Flow Duration" < 100 THEN {_text(RULE_LABELS[1])} ELSE {_text(RULE_LABELS[2])} END'
)
CLEAN = _cast(FLOW_FEATURES, _clean)
TEXT_FEATURES = ", ".join(_quoted(n) for n in FLOW_FEATURES)
JSON = "json_object(" + ", ".join(f"{_text(n)}, {_quoted(n)}" for n in TEXT_COLUMNS) + ")"
DAMAGED = (
    "CASE flow_id % 25 WHEN 1 THEN '{bad' WHEN 2 THEN '' WHEN 3 THEN '[1]' WHEN 4 THEN '3' "
    """WHEN 5 THEN NULL WHEN 6 THEN '{"A": "1"} and more' WHEN 7 THEN '{"A": "1"}{"A": "2"}' """
    f"ELSE CAST({JSON} AS VARCHAR) END"
)
VALID = (
    "coalesce(CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END, false)"
)


#: Scans that keep the label as it is in the file.
LABEL_AS_IS = ("scan_csv", "scan_csv_reordered", "scan_csv_extra_columns")


def _digest(seed: str) -> str:
    return (
        f"CAST('0x' || substr(md5(CAST(flow_id AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT)"
    )


def _below(fraction: float, seed: str = "42") -> str:
    return f"{_digest(seed)} < {int(fraction * 2**32)}"


FLOWS = f"""
events_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), flows AS (
  SELECT event_id AS flow_id, ts,
    CAST(k AS VARCHAR) AS "Destination Port",
    CAST(user_id AS VARCHAR) AS "Flow Duration",
    CASE k % 20 WHEN 0 THEN 'Infinity' WHEN 1 THEN 'NaN' WHEN 2 THEN 'abc' WHEN 3 THEN NULL
      WHEN 4 THEN '' ELSE CAST(value AS VARCHAR) END AS "Flow Bytes/s",
    {RAW_LABEL} AS "Label"
  FROM events_k
), mapped AS (
  SELECT flow_id, ts, {TEXT_FEATURES}, {CLASS} AS "Label" FROM flows
), clean AS (
  SELECT flow_id, ts, {CLEAN}, "Label" FROM mapped
), predicted AS (
  SELECT *, {RULE} AS prediction, {RULE_CLASS} AS "Predicted_Attack" FROM clean
), sampled AS (
  SELECT * FROM clean WHERE "Label" <> {_text(EXCLUDED_CLASS)}
    AND ("Label" IN ({_list(RARE_CLASSES)}) OR {_below(0.1)})
), messages AS (
  SELECT flow_id, ts, {DAMAGED} AS value FROM flows
), indexes AS (
  SELECT "Label", CAST(row_number() OVER (ORDER BY count(*) DESC, "Label") - 1 AS DOUBLE)
    AS label_indexed
  FROM mapped GROUP BY "Label"
)"""


def _wide_value(position: int) -> str:
    return (
        f"CASE (event_id + {position}) % 97 WHEN 0 THEN 'Infinity' WHEN 1 THEN 'NaN' "
        "WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN 'abc' WHEN 5 THEN '-Infinity' "
        f"ELSE CAST((k * {position + 1} + user_id) % 1000 AS VARCHAR) END"
    )


WIDE = (
    "wide AS (SELECT event_id AS flow_id, "
    + ", ".join(f"{_wide_value(i)} AS {_quoted(n)}" for i, n in enumerate(FEATURES))
    + f", {RAW_LABEL} AS \"Label\" FROM events_k)"
)


def _sql(body: str, *extra: str) -> str:
    return "WITH " + ", ".join([FLOWS, *extra]) + "\n" + body


def _kind(value: str) -> str:
    number = _try(value)
    return (
        f"CASE WHEN {value} IS NULL THEN 'null' WHEN {number} IS NULL THEN 'unparsable' "
        f"WHEN isnan({number}) THEN 'nan' WHEN {number} = 'Infinity'::DOUBLE THEN '+inf' "
        f"WHEN {number} = '-Infinity'::DOUBLE THEN '-inf' ELSE 'valid' END"
    )


_PARSED = ", ".join(
    f"CASE WHEN {VALID} THEN json_extract_string(value, {_text('$.' + chr(34) + n + chr(34))}) "
    f"END AS {_quoted(n)}"
    for n in FLOW_FEATURES
)
_SPLIT = f"CASE WHEN {_below(0.8, 'split:42')} THEN 'train' ELSE 'test' END"
_SPLIT_NAMES = {"train": _below(0.8, "split:42"), "test": f"NOT {_below(0.8, 'split:42')}"}
_DETECTIONS = f'SELECT flow_id, "Predicted_Attack", {TEXT_FEATURES} FROM predicted'
_SUMMARY = 'SELECT "Predicted_Attack", count(*) AS "count" FROM predicted GROUP BY 1'
_PER_MINUTE = (
    "SELECT date_trunc('minute', ts) AS window_start, \"Label\", count(*) AS \"count\" "
    "FROM mapped GROUP BY 1, 2"
)
# CSV has no empty text: it is read as NULL.
_SKETCHES = " UNION ALL ".join(
    f"SELECT {_text(n)} AS \"column\", count(DISTINCT nullif({_quoted(n)}, '')) AS exact, "
    f"count(nullif({_quoted(n)}, '')) AS \"values\", "
    f"count(*) FILTER (nullif({_quoted(n)}, '') IS NULL) AS missing, "
    "true AS same_merged, true AS within_error FROM flows"
    for n in TEXT_COLUMNS
)
_TRAINING_SET = f'SELECT flow_id, {TEXT_FEATURES}, "Label" FROM sampled'
_ETL_CLEAN = f'SELECT flow_id, {TEXT_FEATURES}, "Label" FROM clean'
_DAMAGED_STATUS = (
    "CASE flow_id % 50 WHEN 7 THEN 'short' WHEN 11 THEN 'long' WHEN 13 THEN 'long' "
    "ELSE 'good' END"
)
# Labels absent from the input of a class sum count as zero on both sides.
_METRICS = f"""
scored AS (
  SELECT label_indexed AS y, prediction AS p FROM predicted JOIN indexes USING ("Label")
), classes AS (
  SELECT c, sum(CASE WHEN y = c THEN 1 ELSE 0 END)::DOUBLE AS actual,
    sum(CASE WHEN p = c THEN 1 ELSE 0 END)::DOUBLE AS guessed,
    sum(CASE WHEN y = c AND p = c THEN 1 ELSE 0 END)::DOUBLE AS hit
  FROM scored, (SELECT DISTINCT label_indexed AS c FROM indexes) GROUP BY c
), rates AS (
  SELECT actual / sum(actual) OVER () AS w,
    CASE WHEN actual > 0 THEN hit / actual ELSE 0 END AS r,
    CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END AS p
  FROM classes
)"""


def oracle_sql() -> dict[str, str]:
    tests = f"SELECT * FROM sampled WHERE {_SPLIT_NAMES['test']}"
    wide_columns = ", ".join(_quoted(n) for n in FEATURES)
    sql = {
        **dict.fromkeys(LABEL_AS_IS, _ETL_CLEAN.replace("FROM clean", "FROM raw_label_clean")),
        "scan_csv_inferred": 'SELECT CAST(flow_id AS INTEGER) AS flow_id, '
        'CAST("Destination Port" AS INTEGER) AS "Destination Port", '
        'CAST("Flow Duration" AS INTEGER) AS "Flow Duration", "Label" FROM flows',
        "scan_multi_file": 'SELECT flow_id % 8 AS feed, count(*) AS "count" FROM flows GROUP BY 1',
        "scan_bad_rows": f'SELECT {_DAMAGED_STATUS} AS status, count(*) AS "count", '
        "count(flow_id) AS with_first_field FROM flows GROUP BY 1",
        "scan_parquet": _TRAINING_SET,
        "normalize_columns": 'SELECT flow_id, "Destination Port", "Flow Duration", "Label" '
        "FROM flows",
        "rename_strip": 'SELECT flow_id, "Destination Port", "Flow Duration", "Label" FROM flows',
        "cast_and_clean": f"SELECT flow_id, ts, {TEXT_FEATURES} FROM clean",
        "na_fill": "SELECT flow_id, "
        + _cast(
            FLOW_FEATURES,
            lambda e: f"CASE WHEN {_try(e)} IS NULL OR isnan({_try(e)}) THEN 0.0e0 "
            f"ELSE {_try(e)} END",
        )
        + " FROM flows",
        "map_labels": 'SELECT flow_id, "Label" FROM mapped',
        "etl_clean": _ETL_CLEAN,
        "clean_for_inference": f"SELECT flow_id, {TEXT_FEATURES} FROM clean",
        "dashboard_projection": _DETECTIONS,
        "decode_prediction": "SELECT flow_id, CASE WHEN i BETWEEN 0 AND 2 THEN "
        f"[{_list(RULE_LABELS)}][i + 1] ELSE {_text(UNKNOWN_CLASS)} END AS \"Predicted_Attack\" "
        "FROM (SELECT flow_id, CAST(trunc(prediction * 2.4e0 - 0.9e0) AS INTEGER) AS i "
        "FROM predicted)",
        "filter_class": f'SELECT flow_id, "Label" FROM mapped WHERE "Label" <> '
        f"{_text(EXCLUDED_CLASS)}",
        "filter_rare": f'SELECT flow_id, "Label" FROM mapped WHERE "Label" IN '
        f"({_list(RARE_CLASSES)})",
        "filter_common": f'SELECT flow_id, "Label" FROM mapped WHERE "Label" NOT IN '
        f"({_list(RARE_CLASSES)})",
        "filter_null_label": 'SELECT flow_id, "Label" FROM flows WHERE "Label" IS NOT NULL',
        "non_benign_count": 'SELECT count(*) AS "count" FROM flows WHERE "Label" <> \'BENIGN\'',
        "alerts": 'SELECT flow_id, "Predicted_Attack" FROM predicted '
        "WHERE \"Predicted_Attack\" <> 'BENIGN'",
        "row_counts": f'SELECT flow_id % 8 AS feed, {_SPLIT} AS split, count(*) AS "count" '
        "FROM flows GROUP BY 1, 2",
        "label_distribution": 'SELECT "Label", count(*) AS "count" FROM mapped GROUP BY 1 '
        "ORDER BY 2, 1",
        "distinct_labels": 'SELECT DISTINCT "Label" FROM flows',
        "attack_summary": _SUMMARY + " ORDER BY 2 DESC, 1",
        "top_k_attacks": _SUMMARY + " ORDER BY 2 DESC, 1 LIMIT 2",
        "confusion_counts": 'SELECT "Label", prediction, count(*) AS "count" FROM predicted '
        "GROUP BY 1, 2 ORDER BY 1, 2",
        "distinct_per_column": " UNION ALL ".join(
            f"SELECT {_text(n)} AS \"column\", count(DISTINCT {_quoted(n)}) AS distinct_values "
            "FROM flows"
            for n in TEXT_COLUMNS
        ),
        "profile_by_file": """
SELECT flow_id % 8 AS feed, "Label", count(*) AS "count",
  CAST(sum(count(*)) OVER f AS BIGINT) AS file_rows,
  count(*) OVER f AS file_labels,
  CAST(sum(CASE WHEN "Label" <> 'BENIGN' THEN count(*) ELSE 0 END) OVER f AS BIGINT)
    AS file_non_benign
FROM flows GROUP BY 1, 2 WINDOW f AS (PARTITION BY flow_id % 8)""",
        "preview_top_n": _DETECTIONS + " ORDER BY flow_id LIMIT 20",
        "attacks_per_minute": _PER_MINUTE,
        "hash_sample": f"SELECT flow_id FROM flows WHERE {_below(0.1)}",
        "stratified_sample": 'SELECT flow_id, "Label" FROM sampled',
        "hash_split": f"SELECT flow_id, {_SPLIT} AS split FROM flows",
        "row_key_draws": "SELECT count(*) AS \"rows\", CAST(0 AS BIGINT) AS drawn_once, "
        "true AS about_a_tenth FROM flows",
        "row_key_split": "SELECT flow_id, CAST(2 AS BIGINT) AS times, CAST(1 AS BIGINT) AS parts "
        "FROM sampled",
        "random_split_cover": 'SELECT flow_id, CAST(1 AS BIGINT) AS "count" FROM flows',
        "union_strata": 'SELECT flow_id, "Label" FROM sampled',
        "union_files": _ETL_CLEAN,
        "etl_training_set": _TRAINING_SET,
        "build_training_set_csv": _TRAINING_SET,
        "etl_parquet_round_trip": _TRAINING_SET,
        "flows_to_json": "SELECT CAST(flow_id AS VARCHAR) AS key, "
        f'CAST({JSON} AS VARCHAR) AS value, ts AS "timestamp" FROM flows',
        "replay_row_numbers": "SELECT flow_id, row_number() OVER (ORDER BY flow_id) AS row_number "
        "FROM flows",
        "replay_counts": f"SELECT count(*) FILTER ({_DAMAGED_STATUS} <> 'long') AS sent, "
        f"count(*) FILTER ({_DAMAGED_STATUS} = 'long') AS dropped, "
        f"count(*) FILTER ({_DAMAGED_STATUS} <> 'long') AS written FROM flows",
        "parse_messages": "SELECT flow_id, "
        + _cast(FLOW_FEATURES, _try)
        + f" FROM (SELECT flow_id, {_PARSED} FROM messages)",
        "parse_topic": f"SELECT flow_id, {CLEAN} FROM flows",
        "replay_wide": "SELECT count(*) AS sent, count(*) AS written FROM flows",
        "parse_valid_messages": f"SELECT flow_id, {CLEAN} FROM "
        f"(SELECT flow_id, {_PARSED} FROM messages WHERE {VALID})",
        "json_validity": f"""
SELECT flow_id, {VALID} AS is_valid,
  CAST(CASE WHEN {VALID} THEN len(json_keys(value)) ELSE 0 END AS INTEGER) AS n_fields,
  CASE WHEN {VALID} THEN array_to_string(json_keys(value)[1:5], ',') END AS first_fields,
  substr(value, 1, 200) AS beginning
FROM messages""",
        "index_labels": 'SELECT flow_id, "Label", label_indexed FROM mapped '
        'JOIN indexes USING ("Label")',
        "assemble_features": "SELECT flow_id, "
        + ", ".join(f"{_try(_quoted(n))} AS f{i}" for i, n in enumerate(FLOW_FEATURES))
        + " FROM flows WHERE "
        + " AND ".join(
            f"{_try(_quoted(n))} IS NOT NULL AND NOT isnan({_try(_quoted(n))})"
            for n in FLOW_FEATURES
        ),
        "score_invariants": "SELECT count(*) AS scored, count(*) AS in_range, "
        f"count(*) AS sum_to_one FROM ({tests})",
        "forest_shape": f"""
SELECT CAST(20 AS INTEGER) AS trees, CAST(count(DISTINCT "Label") AS INTEGER) AS classes,
  CAST({len(FLOW_FEATURES)} AS BIGINT) AS features, CAST(1 AS DOUBLE) AS importance,
  CAST({len(FLOW_FEATURES)} AS BIGINT) AS not_negative
FROM sampled WHERE {_SPLIT_NAMES['train']}""",
        "evaluation_agrees": f"""
SELECT count(*) AS "rows", true AS accuracy_agrees, true AS recall_agrees,
  true AS precision_agrees, true AS f1_agrees
FROM sampled WHERE {_SPLIT_NAMES['test']} AND {_below(0.3, 'test:42')}""",
        "stream_detect_messages": f"SELECT flow_id, {CLEAN}, true AS known_class FROM flows",
        "model_round_trip": f"SELECT flow_id, true AS same FROM ({tests})",
        "evaluation_counts": f"""
SELECT 'train' AS part, "Label", count(*) AS "count" FROM sampled
WHERE {_SPLIT_NAMES['train']} GROUP BY 1, 2
UNION ALL
SELECT 'scored' AS part, "Label", count(*) AS "count" FROM sampled
WHERE {_SPLIT_NAMES['test']} AND {_below(0.3, 'test:42')} GROUP BY 1, 2""",
        "stream_source": f"SELECT CAST(flow_id AS VARCHAR) AS key, CAST({JSON} AS VARCHAR) "
        "AS value, true AS stamped FROM flows",
        "stream_detections_parquet": _DETECTIONS,
        "stream_attack_summary": _SUMMARY,
        "stream_batch_summary": 'SELECT "Predicted_Attack", count(*) AS "count", '
        "true AS several_batches FROM predicted GROUP BY 1",
        "stream_health": "SELECT count(*) AS messages, count(*) AS valid, "
        "CAST(0 AS BIGINT) AS invalid FROM flows",
        "stream_health_damaged": f"SELECT count(*) AS messages, count(*) FILTER ({VALID}) AS valid, "
        f"count(*) FILTER (NOT {VALID}) AS invalid FROM messages",
        "stream_interval": "SELECT count(*) AS messages, true AS several_batches, "
        "true AS an_interval_apart FROM flows",
        "stream_rate_limit": "SELECT count(*) AS messages, true AS several_batches, "
        "true AS within_limit FROM flows",
        "stream_restart": 'SELECT flow_id, "Predicted_Attack" FROM predicted',
        "stream_attacks_per_minute": _PER_MINUTE,
        # Spark keeps the watermark in whole milliseconds.
        "stream_late_rows": """
SELECT count(*) + 1 AS "read", count(*) FILTER (NOT late) AS counted, CAST(1 AS BIGINT) AS "open",
  count(*) FILTER (late) AS late, count(*) FILTER (late) > 0 AS groups_dropped
FROM (SELECT flow_id % 10 = 3 AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <=
    date_trunc('milliseconds', max(ts) FILTER (flow_id % 10 <> 3) OVER ()) - INTERVAL 10 MINUTE
    AS late FROM flows)""",
        "detections_compacted": 'SELECT flow_id, "Predicted_Attack", '
        "CASE WHEN ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM flows) THEN CAST(4 AS BIGINT) "
        "ELSE CAST(2 AS BIGINT) END AS reads, true AS fewer_files FROM predicted",
        "distinct_sketches": _SKETCHES,
        "stream_score": "SELECT flow_id, CAST(1 AS BIGINT) AS times_streamed, "
        "true AS same_as_batch FROM flows",
    }
    raw_label_clean = f'raw_label_clean AS (SELECT flow_id, {CLEAN}, "Label" FROM flows)'
    result = {
        name: _sql(body, *([raw_label_clean] if name in LABEL_AS_IS else []))
        for name, body in sql.items()
    }
    result["etl_clean_wide"] = _sql(
        f'SELECT flow_id, {_cast(FEATURES, _clean)}, {CLASS} AS "Label" FROM wide', WIDE
    )
    result["parse_messages_wide"] = _sql(
        f"SELECT flow_id, {_cast(FEATURES, _clean)} FROM wide", WIDE
    )
    result["etl_training_set_wide"] = _sql(
        f"SELECT * FROM (SELECT flow_id, {_cast(FEATURES, _clean)}, {CLASS} AS \"Label\" "
        f'FROM wide) WHERE "Label" <> {_text(EXCLUDED_CLASS)} '
        f'AND ("Label" IN ({_list(RARE_CLASSES)}) OR {_below(0.1)})',
        WIDE,
    )
    result["invalid_value_profile"] = _sql(
        f'SELECT "column", {_kind("value")} AS kind, count(*) AS "count" '
        f"FROM (SELECT {wide_columns} FROM wide) UNPIVOT INCLUDE NULLS "
        f'(value FOR "column" IN ({wide_columns})) '
        "GROUP BY 1, 2",
        WIDE,
    )
    result["classification_metrics"] = _sql(
        """
SELECT round(sum(w * r), 6) AS accuracy, round(sum(w * r), 6) AS "weightedRecall",
  round(sum(w * p), 6) AS "weightedPrecision",
  round(sum(w * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1
FROM rates""",
        _METRICS,
    )
    return result
