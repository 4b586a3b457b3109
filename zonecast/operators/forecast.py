"""Multi-horizon demand forecasts.

One set of boosted trees per horizon (15, 30, 60 minutes), all horizons fitted in the
same passes by ``boosting.fit`` on the chronological 80 % and scored on the rest:
squared loss, at most 500 rounds at rate 0.05, 31 leaves, and an end after 50 rounds
without gain on a validation slice cut from the end of the training rows (the
reference stops on its test slice, which then also scores it). A random forest of
Spark ML stands beside it for the comparison of learners.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..session import checkpoint_dir, materialize
from . import boosting
from .split import chronological_split

VECTOR = "features_vec"
BOOSTED = "Trees"
KEYS = ("time_bin", "zone_id")


def feature_list(df: DataFrame, with_supply: bool = True) -> list[str]:
    """The 15 base features, plus active_drivers and gap when present."""
    cols = list(P.BASE_FEATURES)
    if with_supply:
        cols += [c for c in P.SUPPLY_FEATURES if c in df.columns]
    return cols


@dataclass
class Forecaster:
    features: list[str]
    models: dict = field(default_factory=dict)        # horizon -> fitted model
    params: dict = field(default_factory=dict)

    @property
    def boosted(self) -> dict[str, boosting.Trees]:
        return {h: m for h, m in self.models.items() if isinstance(m, boosting.Trees)}

    def assemble(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        return VectorAssembler(inputCols=self.features, outputCol=VECTOR,
                               handleInvalid="keep").transform(df)

    def predict(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """J6 + B11: one prediction column per horizon, clamped at 0."""
        if self.boosted:
            df = boosting.predict(df, self.boosted, self.features)
        rest = {h: m for h, m in self.models.items() if h not in self.boosted}
        if not rest:
            return df
        out = self.assemble(df)
        for h, model in rest.items():
            out = model.setPredictionCol(f"__p_{h}").transform(out)
            out = out.withColumn(f"pred_{h}", F.greatest(F.col(f"__p_{h}"), F.lit(0.0))).drop(f"__p_{h}")
        return out.drop(VECTOR)

    def save(self, path: str) -> None:
        """The node table of the boosted horizons, one artifact per other horizon,
        and a card of learners, base values and features."""
        spark = SparkSession.getActiveSession()
        top = path.rstrip("/")
        rows = [(h, type(m).__name__, float(getattr(m, "base", 0.0)), list(self.features)) for h, m in self.models.items()]
        boosting.node_table(spark, self.boosted).coalesce(1).write.mode("overwrite").parquet(f"{top}/_nodes")
        for h, model in self.models.items():
            if h not in self.boosted:
                model.write().overwrite().save(f"{top}/{h}")
        (spark.createDataFrame(rows, "horizon string, learner string, base double, features array<string>")
         .coalesce(1).write.mode("overwrite").parquet(f"{top}/_card"))

    @classmethod
    def load(cls, path: str) -> "Forecaster":
        """The saved horizons with their learners and features; a damaged model
        is an error."""
        from pyspark.ml import regression
        spark, top = SparkSession.getActiveSession(), path.rstrip("/")
        rows = {r["horizon"]: r for r in spark.read.parquet(f"{top}/_card").collect()}
        fc = cls(features=list(next(iter(rows.values()))["features"]))
        bases = {h: r["base"] for h, r in rows.items() if r["learner"] == BOOSTED}
        boosted = boosting.models_of(spark.read.parquet(f"{top}/_nodes"), bases)
        for h, _ in P.HORIZONS:
            if h in boosted:
                fc.models[h] = boosted[h]
            elif h in rows:
                fc.models[h] = getattr(regression, rows[h]["learner"]).load(f"{top}/{h}")
        return fc


def prepare(features: DataFrame, frac: float = 0.8, val_frac: float = 0.1) -> DataFrame:
    """Split columns: ``split`` (train/test) and ``is_val`` (last ``val_frac``
    of the training rows, used for early stopping). The split rows are written
    once; every later step reads that table."""
    s = materialize(chronological_split(features, frac), "split")
    n_train = s.where(F.col("split") == "train").agg(F.count(F.lit(1))).scalar()
    val_start = (n_train.cast("double") * F.lit(1.0 - val_frac)).cast("long")
    return s.withColumn("is_val", (F.col("split") == "train") & (F.col("row_idx") >= val_start))


def train(features: DataFrame, max_iter: int = 500, leaves: int = 31, step_size: float = 0.05, seed: int = P.SEED,
          with_supply: bool = True, learner: str = "gbt", horizons=P.HORIZONS, rows_per_partition: int = 250_000,
          patience: int = 50, max_depth: int = 5, data: DataFrame | None = None) -> tuple[Forecaster, DataFrame]:
    """Fit one model per horizon on the training rows.

    Returns the forecaster and the prepared (split-labelled) data; ``data`` hands in
    rows that are prepared already. ``leaves`` and ``patience`` are those of the
    boosted trees, ``seed`` that of the forest.
    """
    data = prepare(features) if data is None else data
    fc = Forecaster(features=feature_list(features, with_supply),
                    params={"max_iter": max_iter, "max_depth": max_depth, "step_size": step_size, "learner": learner})
    train_only = data.where(F.col("split") == "train")
    if learner == "gbt":
        fc.models = boosting.fit(train_only, fc.features, horizons, "is_val", KEYS, max_iter, step_size, leaves,
                                 levels=max_depth, patience=patience, rows_per_block=rows_per_partition)
        return fc, data

    from pyspark.ml.regression import RandomForestRegressor
    # A fixed row layout (hash placement by key, sorted inside each partition):
    # the forest takes split candidates and bags from seeded samples of the
    # partitions, so a seed gives one model only when every row sits in the
    # same place on every run. The partition count follows the row count.
    parts = max(1, -(-train_only.count() // rows_per_partition))
    train_rows = (fc.assemble(train_only).repartition(parts, "zone_id", "time_bin")
                  .sortWithinPartitions("time_bin", "zone_id").persist())

    def fit(h, target):
        rows = train_rows.withColumn(target, F.col(target).cast("double"))
        return h, RandomForestRegressor(featuresCol=VECTOR, labelCol=target, numTrees=max_iter,
                                        maxDepth=max_depth, seed=seed).fit(rows)

    checkpoint_dir(features.sparkSession)
    try:
        train_rows.count()                      # fill the cache once, before the fits
        # the horizons are independent: their jobs run side by side on the cluster
        with ThreadPoolExecutor(max_workers=len(horizons)) as pool:
            for h, model in pool.map(lambda ht: fit(*ht), horizons):
                fc.models[h] = model
    finally:
        train_rows.unpersist()
    return fc, data


def metrics(scored: DataFrame, horizons=P.HORIZONS) -> DataFrame:
    """RMSE, MAE, R2 per horizon on the test rows, as one aggregate."""
    test = scored.where(F.col("split") == "test")
    aggs = []
    for h, target in horizons:
        y = F.col(target).cast("double")
        e = F.col(f"pred_{h}") - y
        aggs += [F.sum(e * e).alias(f"{h}_sse"), F.sum(F.abs(e)).alias(f"{h}_sae"),
                 F.sum(y).alias(f"{h}_sy"), F.sum(y * y).alias(f"{h}_syy")]
    wide = test.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = []
    for h, _ in horizons:
        sse, sae, sy, syy = (F.col(f"{h}_{k}") for k in ("sse", "sae", "sy", "syy"))
        n = F.col("n")
        sst = syy - sy * sy / n
        rows.append(F.struct(F.lit(h).alias("horizon"), F.sqrt(sse / n).alias("rmse"),
                             (sae / n).alias("mae"), (F.lit(1.0) - sse / sst).alias("r2"),
                             n.alias("n_test")))
    return wide.select(F.inline(F.array(*rows)))


def nodes(spark: SparkSession, fc: Forecaster) -> DataFrame:
    """The stored nodes of a boosted forecaster (``boosting.NODE_SCHEMA``)."""
    if len(fc.boosted) < len(fc.models):
        raise ValueError("only boosted horizons have a node table")
    return boosting.node_table(spark, fc.boosted)


def importance_table(spark: SparkSession, fc: Forecaster, top: int = 15) -> DataFrame:
    """J8 + F4: feature importance per horizon, top ``top``, ranked by split count
    (as the reference) with the share of the whole gain beside it (ties: larger gain,
    then name). A query over the node table; features without a split count too."""
    names = spark.createDataFrame([(h, i, f) for h in fc.models for i, f in enumerate(fc.features)],
                                  "horizon string, id int, name string")
    used = nodes(spark, fc).where("feature >= 0").groupBy("horizon", F.col("feature").alias("id")).agg(
        F.count(F.lit(1)).cast("int").alias("splits"), F.sum("gain").alias("gain"))
    every = names.join(used, ["horizon", "id"], "left").na.fill(0, ["splits"]).na.fill(0.0, ["gain"])
    share = F.coalesce(F.try_divide("gain", F.sum("gain").over(Window.partitionBy("horizon"))), F.lit(0.0))
    rank = F.row_number().over(Window.partitionBy("horizon").orderBy(F.desc("splits"), F.desc("gain"), "name"))
    return (every.select("horizon", F.col("name").alias("feature"), "splits", share.alias("importance"), rank.alias("rank"))
            .where(F.col("rank") <= top))


def model_card(spark: SparkSession, fc: Forecaster) -> DataFrame:
    """Trees, nodes, leaves, depth limit and learning rate per horizon, from the
    node table; a horizon without a tree has a row too."""
    card = spark.createDataFrame([(h,) for h in fc.models], "horizon string").join(
        nodes(spark, fc).groupBy("horizon").agg(
            F.count_distinct("tree").alias("t"), F.count(F.lit(1)).alias("k"), F.count_if(F.col("feature") < 0).alias("l")),
        "horizon", "left")
    size = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    return card.select("horizon", F.lit(fc.params.get("learner", "gbt")).alias("learner"), size("t").alias("num_trees"),
                       size("k").alias("total_nodes"), size("l").alias("num_leaves"),
                       F.lit(int(fc.params.get("max_depth", 0))).alias("max_depth"),
                       F.lit(float(fc.params.get("step_size", 0.0))).alias("step_size"))
