"""Column lists and types of the unified and the curated table."""

from __future__ import annotations

from pyspark.sql import types as T

UNIFIED_SCHEMA = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("source_format", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("text", T.StringType()),
        T.StructField("raw_metadata", T.StringType()),
    ]
)
UNIFIED_COLUMNS = UNIFIED_SCHEMA.fieldNames()

TAGGED_SCHEMA = T.StructType(
    UNIFIED_SCHEMA.fields + [T.StructField("source_lineage_tag", T.StringType())]
)

DETECTION_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("pii_type", T.StringType()),
            T.StructField("matched_text", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("confidence", T.DoubleType()),
            T.StructField("layer", T.StringType()),
        ]
    )
)

LOG_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("original_text", T.StringType()),
            T.StructField("replacement", T.StringType()),
            T.StructField("pii_type", T.StringType()),
            T.StructField("strategy", T.StringType()),
            T.StructField(
                "position",
                T.StructType(
                    [
                        T.StructField("start", T.IntegerType()),
                        T.StructField("end", T.IntegerType()),
                    ]
                ),
            ),
        ]
    )
)

STRING_LIST_TYPE = T.ArrayType(T.StringType())

# Nested columns that may be stored as JSON text, with the type to read them back.
NESTED_COLUMNS: dict[str, T.DataType] = {
    "pii_detections": DETECTION_TYPE,
    "pii_types_found": STRING_LIST_TYPE,
    "anonymization_log": LOG_TYPE,
    "strategies_used": STRING_LIST_TYPE,
}

SCORE_COLUMNS = [
    "completeness_score",
    "consistency_score",
    "format_conformance_score",
    "pii_removal_confidence_score",
]

CURATED_COLUMNS = (
    UNIFIED_COLUMNS
    + ["source_lineage_tag"]
    + ["pii_detections", "pii_types_found", "has_pii", "pii_count", "max_pii_confidence"]
    + ["anonymized_text", "anonymization_log", "anonymization_count", "strategies_used"]
    + SCORE_COLUMNS
    + ["quality_score"]
)
