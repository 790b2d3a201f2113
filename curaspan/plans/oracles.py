"""The same queries as plain SQL, for checking results in another engine."""

from __future__ import annotations

from curaspan.operators.profile import SCORE_COLUMNS
from curaspan.plans.catalog import RUN_ID, RUN_TIME, STRICT_THRESHOLD

# The patterns in their plain form (order, type, confidence, regex).
_PATTERNS = [
    (0, "EMAIL", "0.99", r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"),
    (
        1,
        "PHONE_US",
        "0.95",
        r"(?:\+?1[\s.\-]?)?(?:\(\d{3}\)[\s.\-]?|\d{3}[\s.\-])\d{3}[\s.\-]?\d{4}|\b\d{10}\b",
    ),
    (2, "SSN", "0.99", r"\b\d{3}-\d{2}-\d{4}\b"),
    (3, "CREDIT_CARD", "0.95", r"\b(?:\d{4}[-\s]?){3}\d{1,4}\b"),
    (
        4,
        "IP_ADDRESS",
        "0.85",
        r"\b(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\b",
    ),
]


def _ts(layout: str, column: str = "ts") -> str:
    return (
        f"strftime({column}, '{layout}') || CASE WHEN strftime({column}, '%f') = '000000' "
        f"THEN '' ELSE '.' || strftime({column}, '%f') END || '+00:00'"
    )


_NOTE = """CASE o_orderpriority
    WHEN '1-URGENT' THEN 'Call (' || substr(d, 1, 3) || ') ' || substr(d, 4, 3) || '-' || substr(d, 7, 4) || ' today'
    WHEN '2-HIGH' THEN 'SSN ' || substr(d, 1, 3) || '-' || substr(d, 4, 2) || '-' || substr(d, 6, 4)
      || ', ask clerk.' || o_custkey || '@example.com'
    WHEN '3-MEDIUM' THEN 'Card ' || substr(c, 1, 4) || '-' || substr(c, 5, 4) || '-' || substr(c, 9, 4) || '-'
      || substr(c, 13, 4) || ', mail ops@10.20.30.' || (o_custkey % 256) || '.example.com'
    WHEN '5-LOW' THEN 'Host 192.168.' || (o_custkey % 256) || '.' || (o_orderkey % 256) || ' ref ' || d
    ELSE '' END"""

_ORDERS = f"""ord AS (
  SELECT *, {_NOTE} AS note
  FROM (SELECT *, lpad(o_orderkey::VARCHAR, 10, '7') AS d, lpad(o_orderkey::VARCHAR, 16, '4') AS c FROM orders)
)"""

_RECORDS = f"""{_ORDERS},
untagged AS (
  SELECT 'doc-' || doc_id AS record_id, 'plaintext' AS source_format, 'documents/' || source AS source_file,
         NULL::TIMESTAMP AS ts, text, '{{"lang":"' || lang || '","source":"' || source || '"}}' AS raw_metadata
  FROM documents
  UNION ALL
  SELECT 'conv-' || conv_id || '-' || turn, 'slack', 'conversations', NULL::TIMESTAMP, text,
         '{{"role":"' || role || '"}}'
  FROM conversations
  UNION ALL
  SELECT 'evt-' || event_id, 'events', 'events', ts, concat_ws(' ', event_type, props), '{{}}' FROM events
  UNION ALL
  SELECT 'ord-' || o_orderkey, 'csv', 'orders/' || o_orderstatus,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END,
         concat_ws(' ', nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Clerk ' || o_custkey END, ''),
                   nullif(note, '')),
         '{{"o_orderpriority":"' || o_orderpriority || '"}}'
  FROM ord
),
rec AS (
  SELECT *, source_format || '::' || source_file || '::'
    || coalesce({_ts('%Y-%m-%d %H:%M:%S')}, 'NaT') AS source_lineage_tag
  FROM untagged
)"""


def _candidates(source: str = "rec") -> str:
    """CTEs up to ``cand``: every match of every pattern with its offsets."""
    found = "\n  UNION ALL\n  ".join(
        f"SELECT record_id, {order} AS ord, '{name}' AS pii_type, {confidence}::DOUBLE AS confidence, "
        f"regexp_extract_all(text, '{regex}') AS ms, string_split_regex(text, '{regex}') AS gs "
        f"FROM {source} WHERE regexp_matches(text, '{regex}')"
        for order, name, confidence, regex in _PATTERNS
    )
    return f"""found AS (
  {found}
),
numbered AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found),
cand AS (
  SELECT record_id, ord, pii_type, confidence, 'regex' AS layer, 0 AS layer_rank, ms[i] AS matched_text,
         s AS span_start, s + length(ms[i]) AS span_end
  FROM (
    SELECT *, (coalesce(list_sum(list_transform(gs[1:i], lambda g: length(g))), 0)
             + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0))::BIGINT AS s
    FROM numbered
  )
)"""


def _resolved(source: str, target: str, order: str) -> str:
    """CTEs that keep the best of overlapping rows of ``source``, in the given order."""
    return f"""{target}_grouped AS (
  SELECT record_id,
         list({{'s': span_start, 'e': span_end, 'pii_type': pii_type, 'matched_text': matched_text,
                'confidence': confidence, 'layer': layer}} ORDER BY {order}) AS cs
  FROM {source} GROUP BY record_id
),
{target}_kept AS (
  SELECT record_id, list_reduce(cs, lambda acc, x:
    CASE WHEN len(list_filter(acc, lambda k: x.s < k.e AND k.s < x.e)) = 0
         THEN list_append(acc, x) ELSE acc END, cs[1:0]) AS ks
  FROM {target}_grouped
),
{target} AS MATERIALIZED (
  SELECT record_id, k.pii_type, k.matched_text, k.s AS span_start, k.e AS span_end, k.confidence, k.layer
  FROM (SELECT record_id, unnest(ks) AS k FROM {target}_kept)
)"""


_BEST_FIRST = "confidence DESC, layer_rank, span_start, ord"


def _spans(source: str = "rec") -> str:
    return f"{_candidates(source)},\n{_resolved('cand', 'spans', _BEST_FIRST)}"


_TOKENS = """tokens AS (
  SELECT *, CASE WHEN pii_type IN ('EMAIL', 'PHONE_US', 'SSN', 'CREDIT_CARD', 'PERSON')
                 THEN 'pseudonymization' ELSE 'redaction' END AS strategy,
         CASE WHEN pii_type IN ('EMAIL', 'PHONE_US', 'SSN', 'CREDIT_CARD', 'PERSON')
              THEN '[' || pii_type || '_' || substr(sha256(matched_text), 1, 8) || ']'
              ELSE '[REDACTED_' || pii_type || ']' END AS replacement,
         row_number() OVER (PARTITION BY record_id ORDER BY span_start) - 1 AS pos,
         coalesce(lag(span_end) OVER (PARTITION BY record_id ORDER BY span_start), 0) AS previous_end
  FROM spans
)"""

_SUMMARY = """summary AS (
  SELECT record_id, count(*) AS pii_count, max(confidence) AS max_pii_confidence,
         array_to_string(list_sort(list_distinct(list(pii_type))), ',') AS pii_types,
         array_to_string(list_sort(list_distinct(list(strategy))), ',') AS strategies
  FROM tokens GROUP BY record_id
)"""

_PIECES = """pieces AS (
  SELECT t.record_id, max(t.span_end) AS last_end,
         string_agg(substr(r.text, t.previous_end + 1, t.span_start - t.previous_end) || t.replacement, ''
                    ORDER BY t.span_start) AS head
  FROM tokens t JOIN rec r USING (record_id) GROUP BY t.record_id
)"""

_SCORED = """scored AS MATERIALIZED (
  SELECT *, greatest(least(0.35::DOUBLE * completeness_score + 0.20::DOUBLE * consistency_score
              + 0.15::DOUBLE * format_conformance_score + 0.30::DOUBLE * pii_removal_confidence_score,
              1.0::DOUBLE), 0.0::DOUBLE) AS quality_score
  FROM (
    SELECT r.*, coalesce(s.pii_count, 0) AS pii_count, s.pii_count IS NOT NULL AS has_pii,
           coalesce(s.max_pii_confidence, 0.0::DOUBLE) AS max_pii_confidence,
           coalesce(s.pii_types, '') AS pii_types, coalesce(s.strategies, '') AS strategies,
           coalesce(p.head || substr(r.text, p.last_end + 1), r.text) AS anonymized_text,
           CASE WHEN length(r.text) > 10 THEN 1.0 WHEN length(r.text) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE
             AS completeness_score,
           CASE WHEN r.ts IS NULL THEN 0.0
                WHEN r.ts BETWEEN TIMESTAMP '2010-01-01' AND TIMESTAMP '2030-12-31' THEN 1.0
                ELSE 0.5 END::DOUBLE AS consistency_score,
           CASE len(regexp_extract_all(r.source_lineage_tag, '::')) WHEN 0 THEN 0.0 WHEN 1 THEN 0.5 ELSE 1.0
           END::DOUBLE AS format_conformance_score,
           CASE WHEN s.pii_count IS NULL THEN 1.0 ELSE 0.95 END::DOUBLE AS pii_removal_confidence_score
    FROM rec r LEFT JOIN summary s USING (record_id) LEFT JOIN pieces p USING (record_id)
  )
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_DETECTED = _with(_RECORDS, _spans())
_ANONYMIZED = _with(_RECORDS, _spans(), _TOKENS, _SUMMARY, _PIECES)
_CURATED = _with(_RECORDS, _spans(), _TOKENS, _SUMMARY, _PIECES, _SCORED)

_SPAN_COLUMNS = (
    "record_id, pii_type, matched_text, span_start, span_end, round(confidence, 6) AS confidence, layer"
)

_EVENT_COLUMNS = {
    "source_format": "VARCHAR",
    "source_file": "VARCHAR",
    "ingestion_timestamp": "VARCHAR",
    "source_timestamp": "VARCHAR",
    "text_length": "BIGINT",
    "pii_types_found": "VARCHAR",
    "pii_count": "BIGINT",
    "detection_timestamp": "VARCHAR",
    "strategy": "VARCHAR",
    "pii_type": "VARCHAR",
    "original_length": "BIGINT",
    "replacement": "VARCHAR",
    "anonymization_timestamp": "VARCHAR",
    "quality_score": "DOUBLE",
    "completeness_score": "DOUBLE",
    "pii_removal_confidence_score": "DOUBLE",
    "passed_threshold": "BOOLEAN",
}


def _event(stage: int, name: str, pos: str, source: str, **values: str) -> str:
    columns = ", ".join(
        f"{values[c]} AS {c}" if c in values else f"NULL::{kind} AS {c}"
        for c, kind in {**_EVENT_COLUMNS}.items()
    )
    # A list column reads as an empty string where an event does not have it.
    columns = columns.replace("NULL::VARCHAR AS pii_types_found", "'' AS pii_types_found")
    return (
        f"SELECT {stage}::BIGINT AS stage, {pos}::BIGINT AS pos, '{name}' AS event, "
        f"'{RUN_ID}' AS run_id, record_id, {columns} FROM {source}"
    )


_EVENTS = "events_log AS (\n  " + "\n  UNION ALL\n  ".join(
    [
        _event(
            0, "ingested", "0", "scored",
            source_format="source_format", source_file="source_file",
            ingestion_timestamp=f"'{RUN_TIME}'", source_timestamp=_ts("%Y-%m-%dT%H:%M:%S"),
            text_length="length(text)",
        ),
        _event(
            1, "pii_detected", "0", "scored",
            pii_types_found="pii_types", pii_count="pii_count", detection_timestamp=f"'{RUN_TIME}'",
        ),
        _event(
            2, "anonymized", "pos", "tokens",
            strategy="strategy", pii_type="pii_type", original_length="length(matched_text)",
            replacement="replacement", anonymization_timestamp=f"'{RUN_TIME}'",
        ),
        _event(
            3, "quality_scored", "0", "scored",
            quality_score="round(quality_score, 6)", completeness_score="completeness_score",
            pii_removal_confidence_score="pii_removal_confidence_score",
            passed_threshold=f"quality_score >= {STRICT_THRESHOLD}::DOUBLE",
        ),
    ]
) + "\n)"

_AUDITED = _with(_RECORDS, _spans(), _TOKENS, _SUMMARY, _PIECES, _SCORED, _EVENTS)

_LINEAGE_SUMMARY = f"""{_AUDITED}
SELECT '{RUN_ID}' AS run_id, count(*) AS total_events,
       count(*) FILTER (event = 'ingested') AS ingested,
       count(*) FILTER (event = 'pii_detected') AS pii_detected,
       count(*) FILTER (event = 'anonymized') AS anonymized,
       count(*) FILTER (event = 'quality_scored') AS quality_scored,
       count(DISTINCT record_id) AS records_processed, 'lineage_log.jsonl' AS log_file
FROM events_log"""

# Three runs over parts of the curated table; the run id of each starts with its day.
_RUNS = f"""runs AS (
  SELECT 1 AS day, * FROM scored WHERE source_format <> 'plaintext'
  UNION ALL SELECT 2, * FROM scored WHERE source_format <> 'slack'
  UNION ALL SELECT 3, * FROM scored WHERE has_pii
), per_run AS (
  SELECT '2023090' || day || '{RUN_ID[8:]}' AS run_id, day, sum(3 + pii_count)::BIGINT AS total_events,
         count(DISTINCT record_id) AS records_processed
  FROM runs GROUP BY day
), first_run AS (SELECT record_id, min(day) AS day FROM runs GROUP BY record_id)"""
_RUN_TABLES = _with(_RECORDS, _spans(), _TOKENS, _SUMMARY, _PIECES, _SCORED, _RUNS)

_TICKETS = r"""tickets AS (
  SELECT CASE WHEN l_discount = 0 THEN '' ELSE l_orderkey::VARCHAR END AS record_id,
         CASE WHEN l_tax = 0 THEN '' ELSE 'Supplier ' || l_suppkey END AS assignee_name,
         'supplier.' || l_suppkey || '@example.com' AS assignee_email,
         'Part ' || l_partkey AS project_name,
         l_linestatus AS status,
         CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%m/%d/%Y')
              WHEN 3 THEN strftime(l_shipdate, '%d-%b-%Y') WHEN 4 THEN strftime(l_shipdate, '%Y/%m/%d')
              WHEN 5 THEN strftime(l_shipdate, '%B %d, %Y') WHEN 6 THEN 'no date' ELSE '' END AS due_date,
         CASE l_returnflag
              WHEN 'A' THEN 'Line "' || l_linenumber || '", qty ' || l_quantity::INTEGER || chr(10)
                         || 'call 415-555-' || lpad(l_suppkey::VARCHAR, 4, '0')
              WHEN 'R' THEN 'Mail supplier.' || l_suppkey || '@example.com, please' ELSE '' END AS notes,
         CASE WHEN l_linenumber <= 5 THEN l_shipdate END AS due, l_orderkey, l_suppkey, l_returnflag,
         row_number() OVER (PARTITION BY l_orderkey, l_discount = 0
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, l_shipdate,
                    l_tax, l_discount) AS nth
  FROM lineitem
),
kept_tickets AS (
  SELECT *, CASE WHEN record_id = '' THEN 'repaired' ELSE record_id END AS shown_id,
         trim(concat_ws(' ', nullif(assignee_name, ''), nullif(notes, '')), E' \t\n\r') AS text
  FROM tickets WHERE record_id = '' OR nth = 1
)"""

_DUE_ISO = "strftime(due, '%Y-%m-%dT%H:%M:%S') || '+00:00'"

_BLOCKS = r"""blocks AS (
  SELECT trim(b, E' \t\n\r') AS text FROM (SELECT unnest(string_split(text, E'\n\n')) AS b FROM documents)
  WHERE trim(b, E' \t\n\r') <> ''
)"""

_ENTITY_TEXTS = f"""{_ORDERS},
rec AS (
  SELECT 'ord-' || o_orderkey AS record_id,
         'Order for ' || c_name || ' (' || c_mktsegment || ') in ' || n_name || ', ' || r_name || '. ' || note
           AS text
  FROM ord JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
),
dictionary AS (
  SELECT DISTINCT phrase, label, '\\b' || regexp_escape(phrase) || '\\b' AS re FROM (
    SELECT c_name AS phrase, 'PERSON' AS label FROM customer
    UNION ALL SELECT c_mktsegment, 'ORG' FROM customer
    UNION ALL SELECT n_name, 'GPE' FROM nation
    UNION ALL SELECT r_name, 'GPE' FROM region
    UNION ALL SELECT n_name || ', ' || r_name, 'GPE' FROM nation JOIN region ON n_regionkey = r_regionkey
  )
),
pairs AS (
  SELECT record_id, text, phrase, label, re FROM rec JOIN dictionary ON contains(text, phrase)
),
hits AS (
  SELECT *, unnest(range(1, len(ms) + 1)) AS i
  FROM (SELECT record_id, phrase, label, regexp_extract_all(text, re) AS ms, string_split_regex(text, re) AS gs
        FROM pairs)
),
entity_cand AS (
  SELECT record_id, label AS pii_type, phrase AS matched_text, s AS span_start, s + length(phrase) AS span_end,
         CASE label WHEN 'PERSON' THEN 0.80 WHEN 'ORG' THEN 0.70 ELSE 0.65 END::DOUBLE AS confidence,
         'ner' AS layer, 1 AS layer_rank, 0 AS ord
  FROM (SELECT *, (list_sum(list_transform(gs[1:i], lambda g: length(g))) + (i - 1) * length(phrase))::BIGINT AS s
        FROM hits)
),
{_resolved('entity_cand', 'entities', 'span_end - span_start DESC, span_start')}""".replace("\\\\b", "\\b")

_LOW_COLUMNS = (
    "record_id, source_format, round(quality_score, 6) AS quality_score, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in SCORE_COLUMNS)
    + ", pii_count::BIGINT AS pii_count"
)


def _describe(column: str) -> str:
    v = f"{column}::DOUBLE"
    return f"""{_CURATED}
SELECT count({column}) AS count, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std,
       round(min({v}), 6) AS min, round(quantile_cont({v}, 0.25), 6) AS q25,
       round(quantile_cont({v}, 0.5), 6) AS q50, round(quantile_cont({v}, 0.75), 6) AS q75,
       round(max({v}), 6) AS max
FROM scored"""


def _profile() -> str:
    printed = {
        "record_id": "record_id",
        "source_format": "source_format",
        "source_file": "source_file",
        "timestamp": _ts("%Y-%m-%d %H:%M:%S"),
        "text": "text",
        "raw_metadata": "raw_metadata",
        "source_lineage_tag": "source_lineage_tag",
        "has_pii": "has_pii::VARCHAR",
        "pii_count": "pii_count::VARCHAR",
        "max_pii_confidence": "max_pii_confidence::VARCHAR",
        "anonymized_text": "anonymized_text",
        "anonymization_count": "pii_count::VARCHAR",
        **{c: f"{c}::VARCHAR" for c in [*SCORE_COLUMNS, "quality_score"]},
    }
    # Lists: without the blanks that other engines print, the empty one first.
    quoted = """CASE {0} WHEN '' THEN '[]' ELSE '["' || replace({0}, ',', '","') || '"]' END"""
    printed |= {
        "pii_detections": "'[]'",
        "anonymization_log": "'[]'",
        "pii_types_found": quoted.format("pii_types"),
        "strategies_used": quoted.format("strategies"),
    }
    types = {name: "string" for name in printed} | {
        "timestamp": "timestamp",
        "has_pii": "boolean",
        "pii_count": "int",
        "anonymization_count": "int",
        "max_pii_confidence": "double",
        "quality_score": "double",
        "pii_detections": "array<struct<pii_type:string,matched_text:string,start:int,end:int,"
        "confidence:double,layer:string>>",
        "anonymization_log": "array<struct<original_text:string,replacement:string,pii_type:string,"
        "strategy:string,position:struct<start:int,end:int>>>",
        "pii_types_found": "array<string>",
        "strategies_used": "array<string>",
        **{c: "double" for c in SCORE_COLUMNS},
    }
    present = {"timestamp": "ts", "anonymization_count": "pii_count"}
    lists = {"pii_detections", "anonymization_log", "pii_types_found", "strategies_used"}
    present |= {name: "record_id" for name in lists}
    parts = [
        f"SELECT '{name}' AS column, '{types[name]}' AS dtype, count(*) FILTER ({present.get(name, name)} IS NULL) AS null_count, "
        f"round(count(*) FILTER ({present.get(name, name)} IS NULL) / count(*)::DOUBLE * 100, 6) AS null_pct, "
        # A missing time prints as text, so that the sample is never empty.
        + (
            f"least(min(substr(coalesce({text}, 'NaT'), 1, 60)), 'NaT')"
            if name == "timestamp"
            else f"min(substr({text}, 1, 60))"
        )
        + " AS sample FROM scored"
        for name, text in printed.items()
    ]
    return _CURATED + "\nUNION ALL\n".join(parts)


_DAMAGED = """damaged AS (
  SELECT *, CASE WHEN NOT has_pii THEN 1.0 WHEN replaced >= pii_count THEN 0.95 WHEN replaced > 0 THEN 0.5
            ELSE 0.0 END::DOUBLE AS pii_score
  FROM (
    SELECT *, CASE length(record_id) % 4 WHEN 0 THEN 0.0 WHEN 1 THEN 0.5 ELSE 1.0 END::DOUBLE AS format_score,
           CASE length(text) % 3 WHEN 0 THEN 0 WHEN 1 THEN greatest(pii_count - 1, 0) ELSE pii_count END AS replaced
    FROM scored
  )
)"""

_LICENSE = "(?:MIT|Apache|Public) License"

# Tickets as four folders of files hold them, by order; the last has few columns.
_MIXED = r"""mixed AS (
  SELECT *, l_orderkey % 4 AS part, l_orderkey % 4 = 3 AND l_returnflag = 'A' AS rejected,
         CASE WHEN l_orderkey % 4 = 3 THEN 'n' ELSE notes END AS own_notes
  FROM tickets
),
kept_mixed AS (
  SELECT *, CASE WHEN record_id = '' THEN 'repaired' ELSE record_id END AS shown_id,
         trim(concat_ws(' ', nullif(assignee_name, ''), nullif(own_notes, '')), E' \t\n\r') AS text,
         row_number() OVER (PARTITION BY l_orderkey, record_id ORDER BY nth) AS nth_kept
  FROM mixed WHERE NOT rejected
)"""

_ANOMALIES = """, cutoff AS (
  SELECT avg(pii_count) + 2 * stddev_samp(pii_count) AS c FROM scored
), flagged AS (
  SELECT *, coalesce(pii_count > (SELECT c FROM cutoff), false) AS is_pii_anomaly FROM scored
)
"""

_WEAK = """, low AS (SELECT * FROM scored WHERE quality_score < 0.5),
weak AS (
  SELECT * FROM low
  UNION ALL
  SELECT * FROM scored WHERE (SELECT count(*) FROM low) = 0
    AND quality_score <= (SELECT quantile_cont(quality_score, 0.01) FROM scored)
)
"""

_PIPELINE_RECORDS = f"""{_TICKETS},
{_BLOCKS},
rec AS (
  SELECT 'c' || row_number() OVER () AS record_id, 'slack' AS source_format, TIMESTAMP '2024-01-15 09:00:00' AS ts,
         text, 'a::b::c' AS source_lineage_tag FROM conversations
  UNION ALL
  SELECT 't' || row_number() OVER (), 'csv', due, text, 'a::b::c' FROM kept_tickets
  UNION ALL
  SELECT 'b' || row_number() OVER (), 'plaintext', TIMESTAMP '2024-01-15', text, 'a::b::c' FROM blocks
)"""

_CHAT_ROWS = """
SELECT 'slack' AS source_format,
       '2024-01-15T09:' || lpad((turn % 60)::VARCHAR, 2, '0') || ':00+00:00' AS timestamp, text,
       CASE WHEN turn > 0 THEN 'room-' || conv_id ELSE '' END AS channel, role AS username,
       'U' || lpad(conv_id::VARCHAR, 6, '0') AS user_id, count(*) AS n
FROM conversations GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "pii_candidates": f"{_with(_RECORDS, _candidates())} SELECT {_SPAN_COLUMNS} FROM cand",
    "pii_spans": f"{_DETECTED} SELECT {_SPAN_COLUMNS} FROM spans",
    "pii_record_summary": f"""{_ANONYMIZED}
SELECT record_id, coalesce(pii_types, '') AS pii_types, pii_count IS NOT NULL AS has_pii,
       coalesce(pii_count, 0) AS pii_count, round(coalesce(max_pii_confidence, 0), 6) AS max_pii_confidence
FROM rec LEFT JOIN summary USING (record_id)""",
    "anonymized_text": f"""{_CURATED}
SELECT record_id, anonymized_text, pii_count AS anonymization_count, strategies FROM scored""",
    "anonymization_log": f"""{_ANONYMIZED}
SELECT record_id, matched_text AS original_text, replacement, pii_type, strategy, span_start, span_end
FROM tokens""",
    "price_describe": """
SELECT count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
       round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
       round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max
FROM (SELECT l_extendedprice::DOUBLE AS v FROM lineitem)""",
    "residual_report": f"""{_with(_RECORDS, _candidates())},
reached AS (
  SELECT record_id, span_start, span_end,
         max(span_end) OVER (PARTITION BY record_id ORDER BY span_start, span_end
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM cand
),
clusters AS (
  SELECT record_id, count(*) FILTER (reach IS NULL OR span_start >= reach) AS spans,
         sum(greatest(span_end - greatest(span_start, coalesce(reach, 0)), 0)) AS masked
  FROM reached GROUP BY record_id
)
SELECT source_format, count(*) AS records, coalesce(sum(spans), 0)::BIGINT AS spans,
       coalesce(sum(masked), 0)::BIGINT AS masked_characters, 0::BIGINT AS residual_left
FROM rec LEFT JOIN clusters USING (record_id) GROUP BY source_format""",
    "unique_tokens": f"""{_ANONYMIZED},
digests AS (
  SELECT *, lag(d) OVER near AS before, lead(d) OVER near AS after
  FROM (SELECT DISTINCT pii_type, matched_text, sha256(matched_text) AS d FROM tokens
        WHERE strategy = 'pseudonymization')
  WINDOW near AS (PARTITION BY pii_type, substr(d, 1, 3) ORDER BY d)
),
lengths AS (
  SELECT *, list_max([n FOR n IN range(3, 65)
                      IF n = 3 OR d[1:n - 1] = before[1:n - 1] OR d[1:n - 1] = after[1:n - 1]]) AS digits
  FROM digests
)
SELECT record_id, t.matched_text AS original_text, t.pii_type, strategy, span_start, span_end,
       CASE WHEN d IS NULL THEN replacement ELSE '[' || t.pii_type || '_' || d[1:digits] || ']' END AS replacement
FROM tokens t LEFT JOIN lengths l ON t.pii_type = l.pii_type AND t.matched_text = l.matched_text""",
    "token_referential_counts": f"""{_ANONYMIZED}
SELECT replacement, strategy, count(*) AS spans, count(DISTINCT matched_text) AS originals,
       count(DISTINCT record_id) AS records
FROM tokens GROUP BY replacement, strategy""",
    "quality_scores": f"""{_CURATED}
SELECT record_id, {', '.join(f'round({c}, 6) AS {c}' for c in [*SCORE_COLUMNS, 'quality_score'])}
FROM scored""",
    "quality_statistics": f"""{_CURATED}
SELECT count(*) AS record_count, round(avg(quality_score), 6) AS mean_quality_score,
       round(quantile_cont(quality_score, 0.5), 6) AS median_quality_score,
       round(stddev_samp(quality_score), 6) AS std_quality_score,
       round(count(*) FILTER (quality_score >= 0.8::DOUBLE) / count(*)::DOUBLE * 100, 6) AS pct_above_threshold,
       0.8::DOUBLE AS threshold_used,
       round(count(*) FILTER (has_pii) / count(*)::DOUBLE * 100, 6) AS pct_records_with_pii,
       100.0::DOUBLE AS pct_pii_records_fully_anonymized
FROM scored""",
    "quality_report_file": f"""{_CURATED}
SELECT count(*) AS record_count, 0.8::DOUBLE AS threshold_used, 0.35::DOUBLE AS completeness,
       0.2::DOUBLE AS consistency, 0.15::DOUBLE AS format_conformance, 0.3::DOUBLE AS pii_removal,
       round(avg(quality_score), 4) AS mean_quality_score,
       round(quantile_cont(quality_score, 0.5), 4) AS median_quality_score,
       round(stddev_samp(quality_score), 4) AS std_quality_score,
       round(count(*) FILTER (quality_score >= 0.8::DOUBLE) / count(*)::DOUBLE * 100, 2) AS pct_above_threshold,
       round(count(*) FILTER (has_pii) / count(*)::DOUBLE * 100, 2) AS pct_records_with_pii,
       100.0::DOUBLE AS pct_pii_records_fully_anonymized
FROM scored""",
    "damaged_scores": f"""{_CURATED}, {_DAMAGED}
SELECT format_score AS format_conformance_score, pii_score AS pii_removal_confidence_score,
       round(greatest(least(0.35::DOUBLE * completeness_score + 0.20::DOUBLE * consistency_score
         + 0.15::DOUBLE * format_score + 0.30::DOUBLE * pii_score, 1.0::DOUBLE), 0.0::DOUBLE), 6) AS quality_score,
       count(*) AS records
FROM damaged GROUP BY ALL""",
    "damaged_statistics": f"""{_CURATED}, {_DAMAGED}
SELECT count(*) AS record_count,
       round(count(*) FILTER (has_pii) / count(*)::DOUBLE * 100, 6) AS pct_records_with_pii,
       round(count(*) FILTER (has_pii AND replaced >= pii_count) / count(*) FILTER (has_pii)::DOUBLE * 100, 6)
         AS pct_pii_records_fully_anonymized
FROM damaged""",
    "custom_pattern_spans": f"""WITH rec AS (SELECT 'doc-' || doc_id AS record_id, text FROM documents),
found AS (
  SELECT record_id, regexp_extract_all(text, '{_LICENSE}') AS ms, string_split_regex(text, '{_LICENSE}') AS gs
  FROM rec WHERE regexp_matches(text, '{_LICENSE}')
),
numbered AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found),
placed AS (
  SELECT record_id, ms[i] AS m, (coalesce(list_sum(list_transform(gs[1:i], lambda g: length(g))), 0)
           + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
  FROM numbered
)
SELECT record_id, 'LICENSE' AS pii_type, m AS matched_text, s AS span_start, s + length(m) AS span_end,
       0.9::DOUBLE AS confidence, 'regex' AS layer
FROM placed""",
    "threshold_summary": f"""{_CURATED}
SELECT count(*) AS records, count(*) FILTER (has_pii) AS pii_records, sum(pii_count)::BIGINT AS replacements,
       count(*) FILTER (quality_score >= {STRICT_THRESHOLD}::DOUBLE) AS passed,
       round(avg(quality_score), 6) AS mean_quality_score
FROM scored""",
    "lineage_events": f"{_AUDITED} SELECT * FROM events_log",
    "lineage_log_file": f"{_AUDITED} SELECT * EXCLUDE (stage, pos) FROM events_log",
    "lineage_event_counts": f"{_AUDITED} SELECT event, count(*) AS events FROM events_log GROUP BY event",
    "lineage_summary": _LINEAGE_SUMMARY,
    "lineage_summary_file": _LINEAGE_SUMMARY,
    "lineage_runs_total": f"""{_RUN_TABLES}
SELECT 'lineage_log.jsonl' AS log_file, count(*) AS runs, sum(total_events)::BIGINT AS total_events,
       max(found) AS records, max(found) <= 65536 AS records_exact
FROM per_run CROSS JOIN (SELECT count(*) AS found FROM first_run)""",
    "lineage_records_added": f"""{_RUN_TABLES}
SELECT 'lineage_log.jsonl' AS log_file, run_id, total_events, records_processed,
       (SELECT count(*) FROM first_run f WHERE f.day = p.day) AS new_records FROM per_run p""",
    "lineage_run_stamps": f"""{_AUDITED}
SELECT event, count(*) AS events, 1 AS run_ids, true AS well_formed,
       CASE event WHEN 'quality_scored' THEN 0 ELSE 1 END AS stamps
FROM events_log GROUP BY event""",
    "report_guard": f"""{_CURATED}
SELECT 'quality_score' AS refused_without, count(*) AS records,
       round(avg(quality_score), 4) AS mean_quality_score FROM scored""",
    "csv_dedup_repair": f"""{_with(_TICKETS)}
SELECT shown_id AS record_id, 'csv' AS source_format, {_DUE_ISO} AS timestamp, text, count(*) AS n
FROM kept_tickets GROUP BY ALL""",
    "csv_metadata": f"""{_with(_TICKETS)}
SELECT shown_id AS record_id, assignee_name, assignee_email, project_name, status, due_date, notes,
       CASE WHEN record_id = '' THEN true END AS record_id_was_missing, true AS id_agrees, count(*) AS n
FROM kept_tickets GROUP BY ALL""",
    "csv_records_across_splits": f"""{_with(_TICKETS)}
SELECT record_id, assignee_name, assignee_email, project_name, status, due_date, notes, count(*) AS n
FROM tickets GROUP BY ALL""",
    "csv_counters": f"""{_with(_TICKETS)}
SELECT count(*) AS rows_read, count(*) FILTER (record_id = '') AS ids_repaired,
       count(*) FILTER (record_id <> '' AND nth > 1) AS duplicates_dropped
FROM tickets""",
    "due_date_parse": f"""{_with(_TICKETS)}
SELECT due_date, count(*) AS n, {_DUE_ISO} AS parsed FROM tickets GROUP BY due_date, due""",
    "due_date_layouts": """
SELECT due_date, count(*) AS n,
       strftime(l_shipdate, '%Y-%m-%dT') || CASE l_linenumber WHEN 2 THEN '15:30:00+00:00' ELSE '00:00:00+00:00' END
         AS parsed
FROM (
  SELECT l_shipdate, l_linenumber, CASE l_linenumber
    WHEN 1 THEN strftime(l_shipdate, '%m/%d/%y') WHEN 2 THEN strftime(l_shipdate, '%m/%d/%Y') || ' 3:30 PM'
    WHEN 3 THEN strftime(l_shipdate, '%B %-d %Y') WHEN 4 THEN strftime(l_shipdate, '%Y%m%d')
    WHEN 5 THEN strftime(l_shipdate, '%Y.%m.%d') WHEN 6 THEN strftime(l_shipdate, '%-d-%B-%Y')
    ELSE upper(strftime(l_shipdate, '%b %-d %Y')) END AS due_date
  FROM lineitem
) GROUP BY ALL""",
    "csv_mixed_headers": f"""{_with(_TICKETS, _MIXED)}
SELECT shown_id AS record_id, CASE WHEN part < 3 THEN {_DUE_ISO} END AS timestamp, text,
       CASE WHEN part = 2 THEN 'W' || l_suppkey END AS warehouse, CASE WHEN part < 3 THEN status END AS status,
       count(*) AS n
FROM kept_mixed WHERE record_id = '' OR nth_kept = 1 GROUP BY ALL""",
    "ingest_rejects": f"""{_with(_TICKETS, _MIXED)}
SELECT record_id || ',' || assignee_name || ',a,surplus' AS raw, count(*) AS n
FROM mixed WHERE rejected GROUP BY raw""",
    "ingest_run_report": f"""{_with(_TICKETS, _MIXED, _BLOCKS)}
SELECT 'records csv' AS name, count(*) AS n FROM kept_mixed WHERE record_id = '' OR nth_kept = 1
UNION ALL SELECT 'records plaintext', count(*) FROM blocks
UNION ALL SELECT 'records slack', count(*) FROM conversations
UNION ALL SELECT 'duplicates_dropped', count(*) FROM kept_mixed WHERE record_id <> '' AND nth_kept > 1
UNION ALL SELECT 'ids_repaired', count(*) FROM kept_mixed WHERE record_id = ''
UNION ALL SELECT 'rejected', count(*) FROM mixed WHERE rejected
UNION ALL SELECT 'load_failures', 2""",
    "chat_array_roundtrip": _CHAT_ROWS,
    "chat_elements_across_splits": _CHAT_ROWS,
    "text_mixed": f"""{_with(_BLOCKS)}
SELECT 'plaintext' AS source_format, text, count(*) AS n, count(*) AS ids FROM (
  SELECT text FROM blocks UNION ALL SELECT text FROM blocks
  UNION ALL SELECT c_name || ', ' || c_mktsegment FROM customer
) GROUP BY text""",
    "stable_line_ids": "SELECT count(*) AS same_ids FROM customer",
    "chat_json_roundtrip": _CHAT_ROWS,
    "text_blocks": f"""{_with(_BLOCKS)}
SELECT 'plaintext' AS source_format, text, '{{}}' AS raw_metadata, count(*) AS n FROM blocks GROUP BY text""",
    "text_lines": """
SELECT 'plaintext' AS source_format, c_name || ', ' || c_mktsegment AS text, count(*) AS n, count(*) AS ids
FROM customer GROUP BY ALL""",
    "unify_counts": f"{_with(_RECORDS)} SELECT source_format, count(*) AS records FROM rec GROUP BY source_format",
    "lineage_tags": f"{_with(_RECORDS)} SELECT record_id, source_lineage_tag FROM rec",
    "validation_rules": f"""{_with(_RECORDS, _TICKETS)}
SELECT source_format, source_file, 'timestamp is null' AS rule, count(*) AS bad_rows FROM rec
WHERE source_format = 'slack' AND ts IS NULL GROUP BY ALL
UNION ALL
SELECT source_format, source_file, 'text is null', count(*) FROM rec
WHERE source_format = 'slack' AND text IS NULL GROUP BY ALL
UNION ALL
SELECT source_format, source_file, 'text is blank', count(*) FROM rec
WHERE source_format = 'plaintext' AND trim(text, E' \\t\\n\\r') = '' GROUP BY ALL
UNION ALL
SELECT 'csv', 'tickets', 'record_id is duplicated', count(*) - count(DISTINCT record_id) FROM tickets""",
    "ingest_profile": f"""{_with(_RECORDS)}
SELECT source_format, count(*) AS records, count(*) FILTER (ts IS NULL) AS null_timestamps,
       count(*) FILTER (text IS NULL OR text = '') AS empty_texts
FROM rec GROUP BY source_format""",
    "ingest_preview": f"""{_with(_RECORDS)}
SELECT source_format, nth, substr(record_id, 1, 8) AS record_id,
       substr(coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S'), 'NaT'), 1, 19) AS timestamp,
       replace(substr(text, 1, 55), chr(10), ' ') AS text
FROM (SELECT *, row_number() OVER (PARTITION BY source_format ORDER BY source_file, record_id) AS nth FROM rec)
WHERE nth <= 2""",
    "curated_json_roundtrip": f"{_DETECTED} SELECT {_SPAN_COLUMNS} FROM spans",
    "dictionary_spans": f"""{_with(_ENTITY_TEXTS)}
SELECT record_id, pii_type AS label, matched_text, span_start, span_end FROM entities""",
    "two_layer_spans": f"""{_with(
        _ENTITY_TEXTS,
        _candidates(),
        '''both_layers AS (
  SELECT record_id, pii_type, matched_text, span_start, span_end, confidence, layer, layer_rank, ord FROM cand
  UNION ALL
  SELECT record_id, pii_type, matched_text, span_start, span_end,
         CASE pii_type WHEN 'PERSON' THEN 0.80 WHEN 'ORG' THEN 0.70 ELSE 0.65 END::DOUBLE, 'ner', 1, 0
  FROM entities
)''',
        _resolved('both_layers', 'spans', _BEST_FIRST),
    )} SELECT {_SPAN_COLUMNS} FROM spans""",
    "streaming_curation": f"""{_CURATED}
SELECT record_id, anonymized_text, pii_count, round(quality_score, 6) AS quality_score
FROM scored WHERE source_format = 'plaintext'""",
    "pipeline_run": f"""{_with(_PIPELINE_RECORDS, _spans(), _TOKENS, _SUMMARY, _PIECES, _SCORED)}
SELECT source_format, count(*) AS records, count(*) FILTER (has_pii) AS pii_records, sum(pii_count)::BIGINT AS spans,
       round(avg(quality_score), 6) AS mean_quality_score,
       count(*) FILTER (quality_score >= 0.8::DOUBLE) AS passed,
       count(*) AS logged, sum(length(text))::BIGINT AS text_length, (SELECT count(*) FROM scored) AS records_processed,
       (SELECT count(*) FROM scored) AS reported_records,
       (SELECT round(avg(quality_score), 4) FROM scored) AS reported_mean, 0 AS rejected_rows
FROM scored GROUP BY source_format""",
    # The first start broke after the log: only the run as a whole was started twice.
    "pipeline_resume": f"""{_with(_PIPELINE_RECORDS, _spans(), _TOKENS, _SUMMARY, _PIECES, _SCORED)}
SELECT stage, started, finished, events, 1 AS run_ids
FROM (VALUES ('ingest', 2, 2), ('curate', 1, 1), ('run', 2, 1)) v(stage, started, finished)
CROSS JOIN (SELECT sum(3 + pii_count)::BIGINT AS events FROM scored WHERE source_format <> 'slack')""",
    "column_profile": _profile(),
    "records_per_format": f"{_with(_RECORDS)} SELECT source_format, count(*) AS records FROM rec GROUP BY ALL",
    "pii_rate": f"""{_CURATED}
SELECT source_format, count(*) AS total, count(*) FILTER (has_pii) AS with_pii,
       round(count(*) FILTER (has_pii) / count(*)::DOUBLE * 100, 6) AS pct_with_pii
FROM scored GROUP BY source_format""",
    "type_frequency": f"""{_DETECTED}
SELECT pii_type, count(DISTINCT record_id) AS records FROM spans GROUP BY pii_type""",
    "pii_histogram": f"""{_CURATED}
SELECT b.pii_count, count(s.record_id) AS records
FROM (SELECT unnest(range(0, (SELECT max(pii_count) FROM scored) + 1)) AS pii_count) b
LEFT JOIN scored s ON s.pii_count = b.pii_count GROUP BY b.pii_count""",
    "pii_describe": _describe("pii_count"),
    "quality_describe": _describe("quality_score"),
    "quality_histogram": f"""{_CURATED},
ends AS (SELECT min(quality_score) AS low, max(quality_score) AS high FROM scored),
edges AS (SELECT low, (high - low) / 30.0::DOUBLE AS width FROM ends),
bins AS (SELECT unnest(range(0, 30)) AS bin),
placed AS (
  SELECT s.record_id, (SELECT max(bin) FROM bins WHERE low + bin * width <= s.quality_score) AS bin
  FROM scored s CROSS JOIN edges
)
SELECT b.bin, round(low + b.bin * width, 6) AS bin_from, round(low + (b.bin + 1) * width, 6) AS bin_to,
       count(p.record_id) AS records
FROM bins b CROSS JOIN edges LEFT JOIN placed p ON p.bin = b.bin GROUP BY b.bin, low, width""",
    "above_threshold": f"""{_CURATED}
SELECT count(*) FILTER (quality_score >= 0.8::DOUBLE) AS passed, count(*) AS records,
       round(count(*) FILTER (quality_score >= 0.8::DOUBLE) / count(*)::DOUBLE * 100, 6) AS pct_above
FROM scored""",
    "box_statistics": f"""{_CURATED},
boxes AS (
  SELECT source_format, quantile_cont(quality_score, 0.25) AS q25, quantile_cont(quality_score, 0.5) AS median,
         quantile_cont(quality_score, 0.75) AS q75,
         count(*) FILTER (quality_score >= 0.8::DOUBLE) / count(*)::DOUBLE * 100 AS pct_above
  FROM scored GROUP BY source_format
)
SELECT source_format, round(any_value(q25), 6) AS q25, round(any_value(median), 6) AS median,
       round(any_value(q75), 6) AS q75, round(min(quality_score), 6) AS whisker_low,
       round(max(quality_score), 6) AS whisker_high, round(any_value(pct_above), 6) AS pct_above
FROM scored JOIN boxes USING (source_format)
WHERE quality_score BETWEEN q25 - 1.5::DOUBLE * (q75 - q25) AND q75 + 1.5::DOUBLE * (q75 - q25)
GROUP BY source_format""",
    "dimension_means": f"""{_CURATED}
SELECT source_format, {', '.join(f'round(avg({c}), 6) AS {c}' for c in SCORE_COLUMNS)}
FROM scored GROUP BY source_format""",
    "low_quality": f"{_CURATED} SELECT {_LOW_COLUMNS} FROM scored WHERE quality_score < 0.5::DOUBLE",
    "weakest_1pct": f"""{_CURATED}
SELECT {_LOW_COLUMNS} FROM scored
WHERE quality_score <= (SELECT quantile_cont(quality_score, 0.01) FROM scored)""",
    "worst_dimension": f"""{_CURATED} {_WEAK}
SELECT dimension, round(mean, 6) AS mean FROM (
  {' UNION ALL '.join(f"SELECT {i} AS place, '{c}' AS dimension, avg({c}) AS mean FROM weak" for i, c in enumerate(SCORE_COLUMNS))}
) ORDER BY mean, place LIMIT 1""",
    "pii_anomalies": f"{_CURATED} {_ANOMALIES} SELECT record_id, pii_count, is_pii_anomaly FROM flagged",
    "anomaly_breakdown": f"""{_CURATED} {_ANOMALIES}
SELECT source_format, count(*) AS anomaly_records, max(pii_count) AS max_pii_count,
       round(avg(pii_count), 6) AS mean_pii_count
FROM flagged WHERE is_pii_anomaly GROUP BY source_format""",
    "scatter_data": f"""{_CURATED} {_ANOMALIES}
SELECT pii_count, round(quality_score, 6) AS quality_score, is_pii_anomaly, count(*) AS records
FROM flagged GROUP BY ALL""",
}
