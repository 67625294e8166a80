"""tidewatch — drift and model-lifecycle analytics expressed as Spark plans.

Everything here builds DataFrame / SQL / Spark ML / Structured Streaming
plans; no per-row Python sits on the data path.
"""

from tidewatch.config import DriftConfig, SplitConfig
from tidewatch.session import get_spark, shared_dir, stage_table

__all__ = ["DriftConfig", "SplitConfig", "get_spark", "shared_dir", "stage_table", "detect_drift",
           "detect_drift_split", "detect_drift_against", "reference_profile"]


def __getattr__(name):  # lazy: importing the package must not need a session
    if name in ("detect_drift", "detect_drift_split", "detect_drift_against", "reference_profile"):
        from tidewatch.operators import drift

        return getattr(drift, name)
    raise AttributeError(name)
