"""Schemas: the student table of the reference domain and the log tables.

Fixed values below must equal the reference's for identical results:
column groups, ordinal category lists, request ranges and fill defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (reference domain) ---------------------------------------
NOMINAL = ["school", "sex", "address", "famsize", "Pstatus", "Mjob", "Fjob", "reason", "guardian"]
ORDINAL = {
    "Medu": [0, 1, 2, 3, 4],
    "Fedu": [0, 1, 2, 3, 4],
    "traveltime": [1, 2, 3, 4],
    "studytime": [1, 2, 3, 4],
    "famrel": [1, 2, 3, 4, 5],
    "freetime": [1, 2, 3, 4, 5],
    "goout": [1, 2, 3, 4, 5],
    "Dalc": [1, 2, 3, 4, 5],
    "Walc": [1, 2, 3, 4, 5],
    "health": [1, 2, 3, 4, 5],
}
BINARY = ["schoolsup", "famsup", "paid", "activities", "nursery", "higher", "internet", "romantic"]
NUMERICAL = ["age", "failures", "absences", "G1", "G2"]
TARGET = "G3"
# Closed integer ranges a scoring request must satisfy.
RANGES = {
    "age": (15, 22), "Medu": (0, 4), "Fedu": (0, 4), "traveltime": (1, 4), "studytime": (1, 4),
    "failures": (0, 4), "famrel": (1, 5), "freetime": (1, 5), "goout": (1, 5), "Dalc": (1, 5),
    "Walc": (1, 5), "health": (1, 5), "absences": (0, 93), "G1": (0, 20), "G2": (0, 20),
}
# Defaults the form fills for fields it does not ask for.
FORM_DEFAULTS = {
    "famsize": "GT3", "Pstatus": "T", "Mjob": "other", "Fjob": "other", "reason": "course", "guardian": "mother",
    "traveltime": 1, "activities": "no", "nursery": "yes", "higher": "yes", "internet": "yes", "romantic": "no",
    "famrel": 4, "Dalc": 1, "Walc": 1,
}
# Grade bands (right-closed, lowest included): [0,5], (5,10], (10,15], (15,20].
GRADE_BAND_EDGES = [0, 5, 10, 15, 20]
# -----------------------------------------------------------------------------

STUDENT_COLUMNS = (
    ["school", "sex", "age", "address", "famsize", "Pstatus", "Medu", "Fedu", "Mjob", "Fjob", "reason",
     "guardian", "traveltime", "studytime", "failures"]
    + BINARY
    + ["famrel", "freetime", "goout", "Dalc", "Walc", "health", "absences", "G1", "G2", "G3"]
)
_STRING = set(NOMINAL) | set(BINARY)


def student_schema(with_target: bool = True, corrupt_column: bool = False) -> T.StructType:
    fields = [
        T.StructField(c, T.StringType() if c in _STRING else T.IntegerType(), True)
        for c in STUDENT_COLUMNS
        if with_target or c != TARGET
    ]
    if corrupt_column:
        fields.append(T.StructField("_corrupt_record", T.StringType(), True))
    return T.StructType(fields)


DRIFT_DETAIL_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("drift_detected", T.BooleanType()),
    T.StructField("statistical_metrics", T.StructType([
        T.StructField("statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType())])),
    T.StructField("reasons", T.ArrayType(T.StringType())),
])

DRIFT_REPORT_SCHEMA = T.StructType([
    T.StructField("summary", T.StructType([
        T.StructField("total_features_analyzed", T.LongType()),
        T.StructField("drifted_features_count", T.LongType()),
        T.StructField("drift_detected_overall", T.BooleanType()),
        T.StructField("timestamp", T.StringType()),
    ])),
    T.StructField("details", T.MapType(T.StringType(), DRIFT_DETAIL_SCHEMA)),
])

METADATA_SCHEMA = T.StructType([
    T.StructField("latest_version", T.IntegerType()),
    T.StructField("current_production_version", T.IntegerType()),
    T.StructField("last_updated", T.StringType()),
    T.StructField("history", T.ArrayType(T.StructType([
        T.StructField("version", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("metrics", T.StructType([
            T.StructField("mae", T.DoubleType()), T.StructField("r2", T.DoubleType())])),
        T.StructField("file", T.StringType()),
    ]))),
])

MODEL_VERSIONS_SCHEMA = T.StructType([
    T.StructField("version", T.IntegerType(), False),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("filepath", T.StringType()),
])
