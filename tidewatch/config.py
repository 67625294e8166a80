"""Tunable parameters (the reference exposes thresholds and window size only)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class DriftConfig:
    # Fixed values that must equal the reference for identical decisions:
    # p-value threshold 0.05, relative mean-shift threshold 0.10 (strict
    # comparisons: p < alpha, shift > threshold).
    p_value_threshold: float = 0.05
    mean_diff_threshold: float = 0.10
    # Scale knobs (ours).  The exact KS running sums are cut into buckets so
    # that no window task holds more than ``rows_per_bucket`` distinct
    # values; ``ks_buckets`` forces a count (1 = plain per-feature window).
    ks_buckets: int | None = None
    rows_per_bucket: int = 1_000_000
    # Write the long-form counts to the shared checkpoint folder once and
    # read them back for every statistic (cuts lineage; one source scan).
    stage: bool = True
    # Samples of at most so many rows a side get the exact KS distribution (a fold of
    # n * m steps per feature); 0 is the asymptotic series at every size.
    ks_exact_up_to: int = 0
    # Optional multiple-testing correction: None, "bonferroni" or "bh".
    correction: str | None = None


@dataclass(frozen=True)
class SplitConfig:
    # Fixed values from the reference's split: test 20 %, validation 12.5 %
    # of the whole (0.125 / 0.8 of the remainder), 5 quantile bins, seed 42.
    test_size: float = 0.2
    val_size: float = 0.125
    n_bins: int = 5
    seed: int = 42
