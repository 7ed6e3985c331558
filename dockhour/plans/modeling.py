"""Model workflows: bake-off (M5), hold-out scoring (K6), repeatability (V5)."""
from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, functions as F

from ..ml import models as M
from ..operators import encoding as TE
from ..operators import features as FE
from ..operators import splits as P
from ..operators.quality import repeatable_predictions
from ..operators.scoring import holdout_report
from ..functions.time import time_parts

KEYS = M.KEYS


def _with_how(df: DataFrame) -> DataFrame:
    return df.withColumn("how", time_parts("ts")["how"]) if "how" not in df.columns else df


def contender_predictions(train: DataFrame, evaluation: DataFrame, contender: str,
                          iters: int = 500) -> DataFrame:
    """Predictions of contender A (identity + TE, Poisson + L1), B (no identity) or
    C (no identity + out-of-fold TE on train, full-train TE on evaluation)."""
    train, evaluation = _with_how(train), _with_how(evaluation)
    keep = KEYS + ["demand"]
    if contender == "A":
        enc = TE.te_fit(train)
        tr = FE.build_features(TE.te_transform(train, enc), "baseline", keep=keep)
        ev = FE.build_features(TE.te_transform(evaluation, enc), "baseline", keep=keep)
        cols = FE.feature_groups()["baseline"]
        model = M.train_baseline(tr, cols, iters=iters)
        return model.transform(ev).select(*keep, "prediction")
    cols = FE.feature_groups()["no_identity"]
    tr = FE.build_features(train, "no_identity", keep=keep + ["how"])
    ev = FE.build_features(evaluation, "no_identity", keep=keep + ["how"])
    if contender == "C":
        tr = TE.te_oof(P.kfold_assign(tr, KEYS, 5)).drop("fold")
        ev = TE.te_transform(ev, TE.te_fit(train))
        cols = cols + ["te_city", "te_city_how", "te_station", "te_station_how"]
    stages = M._prep(cols, "b") + [M.gbt("b", iters=iters, step=0.05)]
    model = Pipeline(stages=stages).fit(tr)
    return (model.transform(ev).withColumn("prediction", F.greatest(F.lit(0.0), F.col("pred_b")))
            .select(*keep, "prediction"))


def bakeoff(train: DataFrame, evaluation: DataFrame, holdout_city: str, sample_fraction: float = 0.35,
            iters: int = 500, contenders=("A", "B", "C")) -> DataFrame:
    """M5: per contender, per-city MAE and the blended MAE on the evaluation rows;
    ``best`` marks the lowest blended MAE.  Train rows are hash-sampled (P5)."""
    sample = P.fraction_sample(train, KEYS, sample_fraction)
    parts = []
    for c in contenders:
        pred = contender_predictions(sample, evaluation, c, iters)
        per = M.per_city_mae(pred)
        b = M.blended(per, holdout_city)
        parts.append(per.withColumns({"contender": F.lit(c),
                                      "blended_mae": b.select("blended_mae").scalar()}))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    best = out.select(F.min_by("contender", F.struct("blended_mae", "contender"))).scalar()
    return out.withColumn("best", F.col("contender") == best)


def score_holdout(pool: DataFrame, train_cities, unseen_cities, val_fraction: float = 0.2,
                  iters: int = 600, gate_iters: int = 400) -> DataFrame:
    """K6: train the ensemble on the in-distribution cities' train part, score their
    val part and every row of the unseen cities; per city its role, MAE, RMSE and means."""
    ind = pool.filter(F.col("city_key").isin(list(train_cities)))
    unseen = pool.filter(F.col("city_key").isin(list(unseen_cities)))
    if ind.join(unseen.select("city_key").distinct(), "city_key", "left_semi").limit(1).count():
        raise P.LeakageError("an unseen city is also a training city")
    ind = ind.withColumn("_us", P.micros("ts"))
    cuts = P.exact_quantile(ind, ["city_key"], "_us", 1.0 - val_fraction, levels=(P.HOUR_US,), out="_cut")
    ind = ind.join(cuts, "city_key")
    train = ind.filter(F.col("_us") <= F.col("_cut")).drop("_us", "_cut")
    val = ind.filter(F.col("_us") > F.col("_cut")).drop("_us", "_cut")
    model = M.train_ensemble(train, iters=iters, gate_iters=gate_iters)
    evaluation = val.unionByName(unseen, allowMissingColumns=True)
    pred = M.predict_ensemble(model, evaluation, KEYS + ["demand"])
    return holdout_report(pred, train_cities)


def repeatable(model: M.EnsembleModel, df: DataFrame) -> DataFrame:
    """V5: predict twice, the second time on re-ordered rows; count differences."""
    a = M.predict_ensemble(model, df).withColumn("id", F.concat_ws("|", *KEYS))
    b = M.predict_ensemble(model, P.shuffle_rows(df, KEYS)).withColumn("id", F.concat_ws("|", *KEYS))
    return repeatable_predictions(a, b)
