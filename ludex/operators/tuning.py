"""Model search for ALS: k folds over the train rows, a grid of parameters,
every fold on all rows; the best parameters are fitted again on all of train."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludex.functions.columns import hash_bucket
from ludex.operators import als as als_op
from ludex.operators.evaluate import rmse
from ludex.session import stage_table

FOLDS = 3
# (rank, regParam): the parameters of the reference run and others around them.
GRID = ((als_op.ALS_RANK, als_op.ALS_REG_PARAM), (als_op.ALS_RANK, 0.1), (5, 0.1), (5, 0.5))


@dataclass
class Trial:
    fold: int
    rank: int
    reg: float
    rmse: float
    n: int


def fold_of(key: Column, folds: int = FOLDS) -> Column:
    """The fold of a row: a hash of its key, independent of the 80/20 split."""
    return hash_bucket(F.concat(F.lit("fold|"), key), folds)


def fold_rows(rows: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Per fold of the train ``rows`` (user_id, item, rkey): n_held, n_fit and
    n_scored, the held rows whose user and item both occur in the rest."""
    cells = stage_table(rows.select("user_id", "item", fold_of(F.col("rkey"), folds).alias("fold"))
                        .groupBy("user_id", "item", "fold").agg(F.count(F.lit(1)).alias("n")),
                        "folds")
    known = cells
    for side in ("user_id", "item"):
        # A user is in the rest of fold f if it has a row of another fold.
        seen = stage_table(cells.groupBy(side).agg(
            F.min("fold").alias(f"_lo_{side}"), F.max("fold").alias(f"_hi_{side}")), "seen")
        known = known.join(seen, side)
    both = [(F.col(f"_lo_{s}") < F.col("fold")) | (F.col(f"_hi_{s}") > F.col("fold"))
            for s in ("user_id", "item")]
    total = cells.select(F.sum("n")).scalar()
    return known.groupBy("fold").agg(
        F.sum("n").alias("n_held"),
        F.coalesce(F.sum(F.when(both[0] & both[1], F.col("n"))), F.lit(0)).alias("n_scored")
    ).select("fold", (total - F.col("n_held")).alias("n_fit"), "n_held", "n_scored")


def search(ratings: DataFrame, grid=GRID, folds: int = FOLDS,
           max_iter: int = als_op.ALS_MAX_ITER) -> tuple[list[Trial], als_op.AlsRun, Trial]:
    """(trials, the run refitted on all train rows, its result on the test
    rows). A trial's RMSE is that of the held fold on the rating scale. The best
    parameters have the least squared error over all folds; ties go to the
    smaller rank, then to the larger regParam. A fold without a row that can be
    scored counts as none. Eager: one fit per fold and entry of ``grid``."""
    coded, users, items = als_op.coded_ratings(ratings)
    fold = fold_of(F.col("rkey"), folds)
    coded = stage_table(coded.withColumn("_fold", fold), "folds")
    trials = []
    for k in range(folds):
        held = F.col("_train") & (F.col("_fold") == k)
        for rank, reg in grid:
            run = als_op.fit_coded(coded, users, items, F.col("_train") & (F.col("_fold") != k),
                                   rank, max_iter, reg, rest=held)
            row = rmse(als_op.predictions(run), "prediction", "rating").first()
            trials.append(Trial(k, rank, reg, row["rmse"] or 0.0, row["n"]))
    error = {p: sum(t.rmse ** 2 * t.n for t in trials if (t.rank, t.reg) == p) for p in grid}
    rank, reg = min(grid, key=lambda p: (error[p], p[0], -p[1]))
    run = als_op.fit_coded(coded, users, items, F.col("_train"), rank, max_iter, reg)
    row = rmse(als_op.predictions(run), "prediction", "rating").first()
    return trials, run, Trial(-1, rank, reg, row["rmse"], row["n"])
