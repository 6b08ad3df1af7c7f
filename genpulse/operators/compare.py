"""Models against baselines, and where their errors lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.series import KEY

MARKS = (5, 10, 20, 50, 100, 200)


def model_comparison(df: DataFrame, truth: str = "target_fuel", model: str = "prediction", baseline: str = "persistence") -> DataFrame:
    """Two rows, scope all and comparable (both predictions known): n, mae of the model and of the
    baseline, and by how many percent the model's is smaller. One pass."""
    error = lambda c: F.abs(F.col(c) - F.col(truth))
    both = error(model).isNotNull() & error(baseline).isNotNull()

    def row(scope: str, where: Column) -> Column:
        a, b = (F.avg(F.when(where, error(c))) for c in (model, baseline))
        return F.struct(F.lit(scope).alias("scope"), F.count_if(where & error(model).isNotNull()).alias("n"), a.alias("model_mae"), b.alias("baseline_mae"))

    out = df.agg(F.array(row("all", F.lit(True)), row("comparable", both)).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
    better = 100 * F.try_divide(F.col("baseline_mae") - F.col("model_mae"), "baseline_mae")
    return out.withColumns({"improvement": F.round(better, 4), "model_mae": F.round("model_mae", 4), "baseline_mae": F.round("baseline_mae", 4)})


def error_shares(df: DataFrame, exact: float = 1e-6) -> DataFrame:
    """One row over forecast.with_errors(): mean and deviation, predictions over, under and exact, and the percentage of errors beyond each mark."""
    known, off = F.col("error").isNotNull(), F.col("absolute_error")
    beyond = [F.round(100 * F.avg(F.when(known, (off > m).cast("double"))), 4).alias(f"beyond_{m}") for m in MARKS]
    return df.agg(
        F.count("error").alias("n"), F.round(F.avg("error"), 4).alias("bias"), F.round(F.stddev_samp("error"), 4).alias("std"),
        F.count_if(F.col("error") > exact).alias("over"), F.count_if(F.col("error") < -exact).alias("under"), F.count_if(off <= exact).alias("exact"), *beyond,
    )


def negative_sample(df: DataFrame, n: int = 30, target: str = "target_fuel") -> DataFrame:
    """The first n rows of negative target, by generator and time."""
    return df.where(F.col(target) < 0).orderBy("generator_id", "timestamp", "row_id").limit(n)


def negative_targets(df: DataFrame, target: str = "target_fuel") -> DataFrame:
    """Least, mean and largest negative target of each generator that has any, with the status most of them came under."""
    low = df.where(F.col(target) < 0)
    per = low.groupBy(KEY, F.coalesce("status", F.lit("none")).alias("status")).agg(F.count(F.lit(1)).alias("n"), F.min(target).alias("least"), F.sum(target).alias("total"), F.max(target).alias("most"))
    top = F.max_by("status", F.struct("n", "status"))
    out = per.groupBy(KEY).agg(F.sum("n").alias("n"), F.min("least").alias("least"), (F.sum("total") / F.sum("n")).alias("mean"), F.max("most").alias("most"), top.alias("status"))
    return out.withColumns({c: F.round(c, 4) for c in ("least", "mean", "most")})
