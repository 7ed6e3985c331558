"""Count models on MLlib (M1-M6, K6, V5).

The reference's boosted-tree libraries are replaced by MLlib estimators:

* baseline (M1): Poisson GLR + absolute-loss GBT, averaged, clipped at 0, or with the Poisson
  part boosted (``train_boosted_baseline``);
* ensemble (M2/M3): one GBT per feature category (weather, calendar,
  station), a second-level GBT gate trained on out-of-fold base predictions
  plus the three missingness masks, a weekday x hour median fallback when all
  three categories are missing, and a clip at 0.

MLlib trees reject NULL and NaN, so every pipeline starts with one
``SQLTransformer`` that adds ``<col>_missing`` indicators and fills the gaps
with 0 (JVM-side, no Python).  A fitted model is a ``PipelineModel`` plus small
side tables (fallback medians) saved next to it.  Out-of-fold predictions use
hash folds (P4), so the whole fit is a fixed number of Spark jobs.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, functions as F

from ..operators import features as FE
from ..operators import splits as P
from .poisson import PoissonModel, fit_poisson

KEYS = ["city_key", "station_key", "ts"]
CATEGORIES = ("weather", "calendar", "station")
MASKS = ["miss_weather", "miss_calendar", "miss_station"]


def _prep(cols, tag: str) -> list:
    """Missing indicators + zero fill (one SQL stage), then a vector assembler."""
    fill = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), 0.0) AS `{tag}_{c}`, "
                     f"CAST(`{c}` IS NULL AS DOUBLE) AS `{tag}_{c}_missing`" for c in cols)
    sql = SQLTransformer(statement=f"SELECT *, {fill} FROM __THIS__")
    inputs = [f"{tag}_{c}" for c in cols] + [f"{tag}_{c}_missing" for c in cols]
    return [sql, VectorAssembler(inputCols=inputs, outputCol=f"{tag}_features", handleInvalid="keep")]


def gbt(tag: str, label: str = "demand", loss: str = "squared", iters: int = 20, depth: int = 5,
        step: float = 0.1, subsample: float = 0.8, weight: str | None = None, seed: int = 42) -> GBTRegressor:
    g = GBTRegressor(featuresCol=f"{tag}_features", labelCol=label, predictionCol=f"pred_{tag}",
                     lossType=loss, maxIter=iters, maxDepth=depth, stepSize=step,
                     subsamplingRate=subsample, seed=seed)
    if weight:
        g.setWeightCol(weight)
    return g


def poisson_glr(tag: str, label: str = "demand", weight: str | None = None) -> GeneralizedLinearRegression:
    g = GeneralizedLinearRegression(featuresCol=f"{tag}_features", labelCol=label, family="poisson",
                                    link="log", predictionCol=f"pred_{tag}_poisson", maxIter=25, regParam=1e-3)
    if weight:
        g.setWeightCol(weight)
    return g


# --- M1 -----------------------------------------------------------------------------------

def train_baseline(train: DataFrame, feature_cols, iters: int = 1500, step: float = 0.03,
                   weight: str | None = None) -> PipelineModel:
    """M1: Poisson GLR and absolute-loss GBT on the same features; the prediction is
    their mean clipped at 0 (a final SQL stage, so the model is one PipelineModel)."""
    tag = "base"
    stages = _prep(feature_cols, tag) + [
        poisson_glr(tag, weight=weight),
        gbt(tag, loss="absolute", iters=iters, step=step, weight=weight),
        SQLTransformer(statement="SELECT *, greatest(0.0, 0.5 * (pred_base_poisson + pred_base)) AS prediction "
                                 "FROM __THIS__")]
    return Pipeline(stages=stages).fit(train)


@dataclass
class BoostedBaseline:
    """Mean of a Poisson boosting and an absolute-loss GBT, clipped at 0."""
    poisson: PoissonModel
    absolute: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        both = self.poisson.predict(self.absolute.transform(df), "pred_base_poisson")
        return both.withColumn("prediction", F.greatest(
            F.lit(0.0), 0.5 * (F.col("pred_base_poisson") + F.col("pred_base"))))


def train_boosted_baseline(train: DataFrame, feature_cols, folder: str, iters: int = 1500,
                           step: float = 0.03, depth: int = 5, weight: str | None = None,
                           chunk: int = 25) -> BoostedBaseline:
    """M1 / M4 with the Poisson objective boosted; its chunks go below ``folder``, from which a
    stopped fit goes on.  ``weight`` enters both models."""
    poisson = fit_poisson(train, feature_cols, folder, weight=weight, rounds=iters, step=step,
                          depth=depth, chunk=chunk)
    tag = "base"
    absolute = Pipeline(stages=_prep(feature_cols, tag) + [
        gbt(tag, loss="absolute", iters=iters, step=step, depth=depth, weight=weight)]).fit(train)
    return BoostedBaseline(poisson, absolute)


# --- M2 / M3 ------------------------------------------------------------------------------

@dataclass
class EnsembleModel:
    base: dict            # category -> PipelineModel (prep + GBT)
    gate: PipelineModel   # masks + base predictions -> prediction
    fallback: DataFrame   # weekday x hour median demand
    global_median: float

    def save(self, path: str) -> None:
        """M6: every part under one folder."""
        for c, m in self.base.items():
            m.write().overwrite().save(f"{path}/base_{c}")
        self.gate.write().overwrite().save(f"{path}/gate")
        (self.fallback.withColumn("global_median", F.lit(self.global_median))
         .write.mode("overwrite").parquet(f"{path}/fallback"))

    @classmethod
    def load(cls, spark, path: str) -> "EnsembleModel":
        base = {c: PipelineModel.load(f"{path}/base_{c}") for c in CATEGORIES}
        gate = PipelineModel.load(f"{path}/gate")
        fb = spark.read.parquet(f"{path}/fallback")
        gm = fb.select(F.first("global_median")).first()[0]
        return cls(base, gate, fb.drop("global_median"), gm)


def category_frame(df: DataFrame, keep=()) -> DataFrame:
    """All three category matrices and the masks side by side (one projection)."""
    d = FE.apply_missingness(df)
    masks = FE.category_missingness(d)
    groups = FE.feature_groups()
    tf = FE.time_features(d, "ts")
    cols = {}
    for cat in CATEGORIES:
        for c in groups[cat]:
            if c in cols:
                continue
            cols[c] = tf[c] if c in tf else (FE._num(d, c) if c in d.columns else F.lit(None).cast("double"))
    return d.select(*[F.col(k) for k in keep], *[v.alias(k) for k, v in cols.items()],
                    *[v.alias(k) for k, v in masks.items()])


def _base_pipeline(cat: str, iters: int, weight: str | None) -> Pipeline:
    cols = FE.feature_groups()[cat]
    return Pipeline(stages=_prep(cols, cat) + [gbt(cat, iters=iters, depth=6, step=0.05, weight=weight)])


def _gate_pipeline(iters: int) -> Pipeline:
    inputs = [f"pred_{c}" for c in CATEGORIES] + MASKS
    return Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="gate_features"),
                            gbt("gate", iters=iters, depth=4, step=0.05)])


def train_ensemble(train: DataFrame, iters: int = 600, gate_iters: int = 400, folds: int = 3,
                   weight: str | None = None, seed: int = 42) -> EnsembleModel:
    """M2: base models per category, out-of-fold predictions for the gate, refit on all."""
    keep = KEYS + ["demand"] + ([weight] if weight else [])
    X = P.kfold_assign(category_frame(train, keep), KEYS, folds, seed)
    from ..session import cut_lineage
    X = cut_lineage(X)                         # read by every fold fit: materialise once
    oof = None
    for k in range(folds):
        part = X.filter(F.col("fold") == k)
        fit_on = X.filter(F.col("fold") != k)
        for cat in CATEGORIES:
            part = _base_pipeline(cat, iters, weight).fit(fit_on).transform(part).select(
                *part.columns, f"pred_{cat}")
        oof = part if oof is None else oof.unionByName(part)
    gate = _gate_pipeline(gate_iters).fit(cut_lineage(oof))
    base = {cat: _base_pipeline(cat, iters, weight).fit(X) for cat in CATEGORIES}
    fb, glob = FE.fallback_median(train)
    fb = cut_lineage(fb)
    gm = train.select(F.median(F.col("demand").cast("double"))).first()[0]
    return EnsembleModel(base, gate, fb, float(gm))


def predict_ensemble(model: EnsembleModel, df: DataFrame, keep=KEYS) -> DataFrame:
    """M3: base predictions + masks -> gate; all masks set -> weekday x hour median
    (else the global median); clipped at 0."""
    X = category_frame(df, keep)
    for cat in CATEGORIES:
        X = model.base[cat].transform(X).select(*X.columns, f"pred_{cat}")
    X = model.gate.transform(X).withColumnRenamed("pred_gate", "prediction")
    out = FE.cold_start_fallback(X, model.fallback, F.lit(model.global_median))
    return out.select(*keep, "prediction", *MASKS)


# --- M5, K6, V5 ---------------------------------------------------------------------------

def per_city_mae(pred: DataFrame, truth_col: str = "demand") -> DataFrame:
    err = F.abs(F.col(truth_col).cast("double") - F.greatest(F.lit(0.0), F.col("prediction")))
    return pred.groupBy("city_key").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(err).alias("mae"))


def blended(per_city: DataFrame, holdout_city: str) -> DataFrame:
    """2/3 * mean(in-distribution city MAE) + 1/3 * holdout MAE (one row)."""
    return per_city.agg(
        (F.lit(2.0 / 3.0) * F.avg(F.when(F.col("city_key") != holdout_city, F.col("mae")))
         + F.lit(1.0 / 3.0) * F.max(F.when(F.col("city_key") == holdout_city, F.col("mae")))).alias("blended_mae"))
