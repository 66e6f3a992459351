"""Classifiers and their evaluation."""

from __future__ import annotations

import math
import random
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.slices import below, rank_from_top
from quantloom.sources.io import kept


#: Stands for an unknown feature; trees can split it off.
UNKNOWN = -1e9


def _known_features(features: list[str], inputs: str = "__THIS__") -> SQLTransformer:
    """Each feature as a double, the unknown value for null."""
    return SQLTransformer(statement="SELECT *, " + ", ".join(f"coalesce(CAST(`{f}` AS DOUBLE), {UNKNOWN!r}D) AS `in_{f}`" for f in features) + f" FROM {inputs}")


def train_classifier(df: DataFrame, features: list[str], label: str, *, rounds: int = 10, depth: int = 3, seed: int = 1) -> PipelineModel:
    """Boosted trees for one horizon; rows without a label are left out, unknown features are a value of their own."""
    filled, ready = _known_features(features), VectorAssembler(inputCols=[f"in_{f}" for f in features], outputCol="features")
    known = df.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))
    model = GBTClassifier(labelCol=label, featuresCol="features", maxIter=rounds, maxDepth=depth, seed=seed).fit(ready.transform(filled.transform(known)))
    return PipelineModel([filled, ready, model])


def _cuts(known: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """By feature, at most bins - 1 values at which bins of about as many known rows each begin, the first one apart; each value if there are so few.

    All rows are counted by the first four digits of their distance from one row's value (that with the least __hash), so there are some ten
    thousand counts to a decade, however many rows and values there are, and neither an offset nor outliers use up the digits.
    """
    start = known.agg(*[F.min_by(f, F.when(F.col(f).isNotNull(), F.col("__hash"))).alias(f) for f in features]).first()
    counts = None
    for f in features:
        away = F.col(f) - F.lit(start[f]).cast("double")
        decade = F.coalesce(F.floor(F.log10(F.abs(away))), F.lit(0))
        one = known.where(F.col(f).isNotNull()).groupBy(F.lit(f).alias("feature"), decade, F.floor(away * F.pow(F.lit(10.0), 3 - decade))).agg(F.count("*").alias("n"), F.min(f).alias("lower")).select("feature", "n", "lower")
        counts = one if counts is None else counts.unionByName(one)
    every, in_order = Window.partitionBy("feature"), Window.partitionBy("feature").orderBy("lower")
    ranked = counts.select("*", F.sum("n").over(in_order).alias("upto"), F.sum("n").over(every).alias("all"), F.count("*").over(every).alias("values"), F.lead("lower").over(in_order).alias("next"))
    ends = ranked.where(f"upto < all AND (values <= {bins} OR upto * {bins} DIV all > (upto - n) * {bins} DIV all)").collect()
    return {f: sorted(r["next"] for r in ends if r["feature"] == f and math.isfinite(r["next"])) for f in features}


def cells(df: DataFrame, features: list[str], label: str, keys: list[str], *, seed: int, fold: Column, blocks: int = 8, parts: int = 16, bins: int = 31) -> DataFrame:
    """Rows with a label, counted: label, features (the numbers of their bins, 0 where unknown), fold and weight, the number of rows.

    Boosted trees see no more of a feature than its 32 bins, which Spark draws from some rows at each fit; here they are drawn from all rows, once, and
    rows that are alike to every tree are one row with a weight. So fits take no longer however many rows there are. The rows of a cell are dealt into
    blocks by a hash of the keys, of which the trees sample their share. fold is a column over __hash. Neither cells nor their order depend on how df is partitioned.
    """
    value = lambda f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f)
    # Written, as starts, cuts and cells each go over it.
    known = kept(df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias(label), *map(value, features), F.xxhash64(F.lit(seed), *keys).alias("__hash")), "known")
    cuts = _cuts(known, features, bins)
    # Some cut is needed, also where there is but one value.
    splits, places = [[-math.inf, *(cuts[f] or [0.0]), math.inf] for f in features], [f"in_{f}" for f in features]
    placed = Bucketizer(splitsArray=splits, inputCols=features, outputCols=places, handleInvalid="keep").transform(known.fillna(math.nan, features))
    block = F.pmod(F.shiftright("__hash", 32), F.lit(blocks)).alias("__block")
    by = [label, "fold", "__block", *places]
    counted = placed.select(label, fold.alias("fold"), block, *[F.when(F.isnan(f), 0.0).otherwise(F.col(p) + 1).alias(p) for f, p in zip(features, places, strict=True)]).groupBy(*by).agg(F.count("*").cast("double").alias("weight"))
    dealt = VectorAssembler(inputCols=places, outputCol="features").transform(counted.repartition(parts, *by).sortWithinPartitions(*by))
    return dealt.select(label, "features", "fold", "weight")


def search(df: DataFrame, features: list[str], label: str, keys: list[str], *, depths: tuple[int, ...] = (2, 3, 4, 5), rounds: tuple[int, ...] = (10, 20), seed: int = 1, parallelism: int = 2):
    """The settings with the highest AUC on a validation fifth, all of the depths with all of the rounds."""
    gbt = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", seed=seed)
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.maxIter, list(rounds)).build()
    judge = BinaryClassificationEvaluator(labelCol=label, weightCol="weight")
    # Written, as the split, each fit and the last one go over them.
    ready = kept(cells(df, features, label, keys, seed=seed, fold=F.lit(0)).drop("fold"), "cells")
    return TrainValidationSplit(estimator=gbt, estimatorParamMaps=grid, evaluator=judge, trainRatio=0.8, seed=seed, parallelism=parallelism).fit(ready)


def drawn_settings(trials: int, seed: int, *, depths: tuple[int, int] = (1, 9), steps: tuple[float, float] = (0.05, 0.15), shares: tuple[float, float] = (0.5, 0.9)) -> list[dict]:
    """Settings drawn at random: tree depth, step, and the shares of rows and of features that a tree sees."""
    rng = random.Random(seed)
    return [{"maxDepth": rng.randint(*depths), "stepSize": rng.uniform(*steps), "subsamplingRate": rng.uniform(*shares), "featureSubsetStrategy": f"{rng.uniform(*shares):.6f}"} for _ in range(trials)]


def random_search(
    df: DataFrame, features: list[str], label: str, keys: list[str], *, settings: list[dict], rounds: int = 5, folds: int = 5, held_out: tuple[int, ...] = (0,), seed: int = 1, parts: int = 16, parallelism: int = 4,
) -> DataFrame:
    """The AUC of each of the settings (trial, those of drawn_settings, auc) on held-out folds, averaged; the best one first.

    Folds and parts are dealt by a hash of the keys, which tell the rows apart, and rows are counted to cells and sorted; so neither the folds nor what the
    trees sample depends on how df is partitioned. Cells are made once for all trials and lie on disk as they are then. The trials run as jobs of one pool of threads.
    """
    fold = F.pmod("__hash", F.lit(folds)).cast("int")
    # Folds that no trial holds out are one.
    rows = cells(df, features, label, keys, seed=seed, fold=F.when(fold.isin(*held_out), fold).otherwise(-1), parts=parts).persist(StorageLevel.DISK_ONLY)
    judge = BinaryClassificationEvaluator(labelCol=label, weightCol="weight")

    def auc_of(trial: tuple[dict, int]) -> float:
        setting, out = trial
        model = GBTClassifier(labelCol=label, featuresCol="features", weightCol="weight", maxIter=rounds, seed=seed, **setting).fit(rows.where(F.col("fold") != out))
        # Spark adds up doubles as tasks end, so the last digits aren't the same each time.
        return round(judge.evaluate(model.transform(rows.where(F.col("fold") == out))), 9)

    with ThreadPool(parallelism) as pool:
        rows.count()
        found = pool.map(inheritable_thread_target(df.sparkSession)(auc_of), [(s, out) for s in settings for out in held_out], chunksize=1)
    rows.unpersist()
    told = [(i, s["maxDepth"], rounds, s["stepSize"], s["subsamplingRate"], float(s["featureSubsetStrategy"]), round(sum(found[i * len(held_out) : (i + 1) * len(held_out)]) / len(held_out), 9)) for i, s in enumerate(settings)]
    schema = "trial int, depth int, rounds int, step double, row_share double, feature_share double, auc double"
    return df.sparkSession.createDataFrame(sorted(told, key=lambda t: (-t[-1], t[0])), schema)


def importances(spark, model: PipelineModel, features: list[str]) -> DataFrame:
    """I3."""
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, model.stages[-1].featureImportances.toArray(), strict=True)], "feature string, importance double")


def score(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """I4: date, code and a column of the positive class's probability per model, in one pass over the rows."""
    out = df
    for name, m in models.items():
        scored = m.transform(out)
        out = scored.withColumn(name, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction", *[c for c in scored.columns if c.startswith("in_")])
    return out.select("date", "code", *models)


def at_thresholds(df: DataFrame, by: list[str], label: str, score: str, thresholds: tuple[float, ...] = tuple(t / 100 for t in range(50, 100, 5))) -> DataFrame:
    """Precision and recall of scores strictly above each threshold, from conditional sums of one pass."""
    y, s = F.col(label), F.col(score)
    sums = [F.struct(F.lit(t).alias("threshold"), F.count_if((s > t) & (y == 1)).alias("tp"), F.count_if(s > t).alias("called"), F.count_if(y == 1).alias("pos")) for t in thresholds]
    return df.groupBy(*by).agg(F.array(*sums).alias("a")).select(*by, F.inline("a")).select(*by, "threshold", F.try_divide("tp", "called").alias("precision"), F.try_divide("tp", "pos").alias("recall"))


def confusion(df: DataFrame, by: list[str], label: str, predicted: str) -> DataFrame:
    """The confusion matrix."""
    return df.groupBy(*by, label, predicted).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Per class precision, recall and support; with accuracy, which is also the recall weighted by support."""
    m = confusion(df, [], label, predicted)
    right = F.when(F.col(label) == F.col(predicted), F.col("n")).otherwise(0)
    rows = m.groupBy(F.col(label).alias("class")).agg(F.sum(right).alias("tp"), F.sum("n").alias("support"))
    called = m.groupBy(F.col(predicted).alias("class")).agg(F.sum("n").alias("called"))
    total = rows.agg((F.sum("tp") / F.sum("support")).alias("accuracy"))
    j = rows.join(called, "class", "left").crossJoin(F.broadcast(total))
    return j.select("class", F.try_divide("tp", "called").alias("precision"), (F.col("tp") / F.col("support")).alias("recall"), "support", "accuracy")


def _by_score(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """Equal scores counted first, so that running sums go over distinct scores."""
    return df.groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))


def auc(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """Exact area under the curve; ties count half. by names at least one column; rows without a score are left out."""
    ranked = below(_by_score(df.where(F.col(score).isNotNull()), by, label, score), by, score, ["q"])
    return ranked.groupBy(*by).agg(F.try_divide(F.sum(F.col("p") * (F.col("below_q") + F.col("q") / 2)), F.sum("p") * F.sum("q")).alias("auc"))


def ks(df: DataFrame, by: list[str], label: str, score: str) -> DataFrame:
    """I8: largest distance between the classes' shares above a score; rows without one are left out."""
    ranked = below(_by_score(df.where(F.col(score).isNotNull()), by, label, score), by, score, ["p", "q"])
    share = lambda c: F.try_divide(F.col(f"all_{c}") - F.col(f"below_{c}"), F.col(f"all_{c}"))
    return ranked.groupBy(*by).agg(F.max(F.abs(share("p") - share("q"))).alias("ks"))


def top_percent(df: DataFrame, by: list[str], score: str, ties: list[str], percent: int = 1) -> DataFrame:
    """1 for the floor(n * percent / 100) rows with the highest scores of a group."""
    return rank_from_top(df, by, score, ties).withColumn("picked", (F.col("__rank") <= F.floor(F.col("__n") * percent / 100)).cast("int")).drop("__rank", "__n")


def blended(df: DataFrame, weights: dict[str, float] | None, columns: list[str]) -> DataFrame:
    """Weighted mean of the horizons' scores; equal weights without any."""
    given = weights or dict.fromkeys(columns, 1.0)
    total = sum(given[c] for c in columns)
    out = F.lit(0.0)
    for c in columns:
        out = out + F.col(c) * (given[c] / total)
    return df.withColumn("blend", out)
