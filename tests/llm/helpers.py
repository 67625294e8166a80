"""Small tables for the operators' tests."""

from __future__ import annotations

import pandas as pd

LONG = " ".join(f"word{i * 7919 % 1009}" for i in range(6000))

TEXTS = [
    "The quick brown fox jumps over the lazy dog near the river bank today",
    "The quick brown fox jumps over the lazy dog near the river bank today",
    "",
    None,
    " ",
    "a",
    "  two  spaces \n and\tmore \n",
    "Schöne Grüße aus München, naïve café été 你好 мир 🎉 <|endoftext|> end",
    LONG,
    LONG + " tail",
    "x" * 5000,
    "mail bob.smith@mail.example.com or +1 (555) 555-0199 from 10.0.0.1 card 4111 1111 1111 1111",
]


def documents(spark, texts=None, ids=None, path=None):
    """``documents`` with a clashing extra column ("size", "rank", ...)."""
    texts = TEXTS if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", 0 if t is None else len(t), "x", 1) for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, part int")
    return df


def table_dir(tmp_path, **frames):
    """Write pandas or Spark frames as ``<name>.parquet`` below a folder."""
    for name, df in frames.items():
        target = str(tmp_path / f"{name}.parquet")
        if isinstance(df, pd.DataFrame):
            df.to_parquet(target)
        else:
            df.write.mode("overwrite").parquet(target)
    return str(tmp_path)
