"""Exact tree splits by prefix sums, and boosting with them.

A split needs, per feature and distinct value, the number of rows and the sum
of their labels; running sums over the values give both sides of every
threshold.  The counts are one aggregate, whatever the number of rows, and the
running sums are range-partitioned, so no feature sits in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.prefix import running_sums
from tidewatch.session import stage_table


def split_sums(df: DataFrame, features: list[str], label: Column) -> DataFrame:
    """(feature, value, n, s): rows and label sums per distinct value; null and NaN values take no part."""
    args = [x for f in features for x in (F.lit(f), F.col(f"`{f}`").cast("double"))]
    rows = df.select(label.cast("double").alias("y"), F.stack(F.lit(len(features)), *args).alias("feature", "value"))
    return rows.filter("value is not null and not isnan(value) and y is not null").groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("y").alias("s"))


def split_gains(sums: DataFrame) -> DataFrame:
    """(feature, threshold, n_left, n_right, mean_left, mean_right, gain) of every threshold, halfway between two values.

    ``gain`` is the fall of the label's variance."""
    total = sums.groupBy("feature").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"))
    cum = running_sums(sums, ["feature"], "value", ["n", "s"], with_next=True).filter("next_value is not null")
    rows = cum.join(F.broadcast(total), "feature")  # one row per feature
    right = F.col("n_all") - F.col("cum_n"), F.col("s_all") - F.col("cum_s")
    left_mean, right_mean, mean = F.col("cum_s") / F.col("cum_n"), right[1] / right[0], F.col("s_all") / F.col("n_all")
    gain = (F.col("cum_n") * (left_mean - mean) ** 2 + right[0] * (right_mean - mean) ** 2) / F.col("n_all")
    return rows.select("feature", ((F.col("value") + F.col("next_value")) / 2).alias("threshold"), F.col("cum_n").alias("n_left"), right[0].alias("n_right"),
                       left_mean.alias("mean_left"), right_mean.alias("mean_right"), gain.alias("gain"))


def best_splits(df: DataFrame, features: list[str], label: Column) -> DataFrame:
    """The best threshold of each feature (ties: the smallest)."""
    gains = split_gains(stage_table(split_sums(df, features, label), "split-sums"))
    best = gains.groupBy("feature").agg(F.max_by(F.struct(*gains.columns[1:]), F.struct("gain", -F.col("threshold"))).alias("b"))
    return best.select("feature", "b.*")


@dataclass(frozen=True)
class Stump:
    feature: str
    threshold: float
    left: float
    right: float
    gain: float

    def value(self) -> Column:
        """Rows without the feature's value get 0: the stump says nothing about them."""
        x = F.col(f"`{self.feature}`").cast("double")
        return F.when(x.isNull() | F.isnan(x), 0.0).when(x <= self.threshold, self.left).otherwise(self.right)


@dataclass(frozen=True)
class Boosted:
    base: float
    stumps: tuple[Stump, ...]

    def prediction(self) -> Column:
        out = F.lit(self.base)
        for s in self.stumps:
            out = out + s.value()
        return out


def boost(df: DataFrame, features: list[str], label: str, rounds: int = 10, rate: float = 0.1) -> Boosted:
    """Gradient boosting of depth-1 trees for squared error: each round fits the residuals, shrunk by ``rate``.

    A round is one aggregate over the rows and one row back to the driver; it ends early when no split gains."""
    base = df.agg(F.avg(F.col(f"`{label}`").cast("double"))).first()[0]
    model = Boosted(float(base or 0.0), ())
    for _ in range(rounds):
        residual = F.col(f"`{label}`").cast("double") - model.prediction()
        best = best_splits(df, features, residual).orderBy(F.desc("gain"), "feature").first()
        if best is None or best["gain"] <= 0:
            break
        stump = Stump(best["feature"], best["threshold"], rate * best["mean_left"], rate * best["mean_right"], best["gain"])
        model = Boosted(model.base, (*model.stumps, stump))
    return model
