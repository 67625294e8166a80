"""Synthetic student table (the reference ships no data): 395 seeded rows,
every category of every nominal column present, G2 ~ G1, G3 ~ G2, 38 zero G3."""

from __future__ import annotations

import numpy as np
import pandas as pd

from tidewatch.schema import BINARY, STUDENT_COLUMNS, student_schema

CATS = {
    "school": ["GP", "MS"], "sex": ["F", "M"], "address": ["U", "R"], "famsize": ["LE3", "GT3"], "Pstatus": ["T", "A"],
    "Mjob": ["teacher", "health", "services", "at_home", "other"], "Fjob": ["teacher", "health", "services", "at_home", "other"],
    "reason": ["home", "reputation", "course", "other"], "guardian": ["mother", "father", "other"],
}
INTS = {"age": (15, 22), "Medu": (0, 4), "Fedu": (0, 4), "traveltime": (1, 4), "studytime": (1, 4), "failures": (0, 3),
        "famrel": (1, 5), "freetime": (1, 5), "goout": (1, 5), "Dalc": (1, 5), "Walc": (1, 5), "health": (1, 5), "absences": (0, 30)}


def student_pandas(n: int = 395, seed: int = 7) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    d = {}
    for c, vals in CATS.items():
        d[c] = [vals[i % len(vals)] for i in range(n)]
        rng.shuffle(d[c])
    for c, (lo, hi) in INTS.items():
        d[c] = rng.integers(lo, hi + 1, n)
    for c in BINARY:
        d[c] = rng.choice(["yes", "no"], n)
    g1 = rng.integers(3, 20, n)
    g2 = np.clip(g1 + rng.integers(-2, 3, n), 0, 20)
    g3 = np.clip(g2 + rng.integers(-1, 2, n), 0, 20)
    g3[:38] = 0
    d["G1"], d["G2"], d["G3"] = g1, g2, g3
    df = pd.DataFrame(d)[STUDENT_COLUMNS]
    for c in list(INTS) + ["G1", "G2", "G3"]:
        df[c] = df[c].astype("int32")
    return df


def student_frame(spark, n: int = 395, seed: int = 7):
    pdf = student_pandas(n, seed)
    pdf.insert(0, "student_id", np.arange(n, dtype="int64"))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("student_id", T.LongType())] + student_schema().fields)
    return spark.createDataFrame(pdf, schema)
