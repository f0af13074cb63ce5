"""Modelling: scaler + boosted trees per target, scoring, AUC and class report.

Spark ML throughout; the loop is over targets (a handful), never over rows."""

from __future__ import annotations

import math


from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import GBT_PARAMS
from ..session import checkpoint_dir


def gbt_pipeline(features: list, label: str, params: dict | None = None) -> Pipeline:
    """Assemble -> standardize (mean and sample deviation, fitted with the model on the
    training rows only) -> gradient-boosted trees."""
    p = dict(GBT_PARAMS)
    p.update(params or {})
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="skip"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        GBTClassifier(featuresCol="features", labelCol=label, predictionCol="prediction", **p),
    ])


def fit_and_score(train: DataFrame, test: DataFrame, features: list, label: str,
                  params: dict | None = None) -> tuple[PipelineModel, DataFrame]:
    """ACTION (fit). Returns the fitted pipeline and the scored test rows with ``score``
    = probability of class 1."""
    # the boosting loop runs several jobs per tree level and every job pays a task per
    # partition: AQE rebalances the rows to its advisory partition size. The rows are
    # checkpointed to the shared folder in the same single pass over the sampling
    # lineage: the loop (and a lost executor's recomputation) starts from there. The
    # boosting loop caches its own input.
    checkpoint_dir(train.sparkSession)
    tr = train.withColumn(label, F.col(label).cast("double")).hint("rebalance").checkpoint(eager=True)
    model = gbt_pipeline(features, label, params).fit(tr)
    scored = model.transform(test.withColumn(label, F.col(label).cast("double")))
    return model, scored.withColumn("score", vector_to_array("probability")[1])


def fit_per_target(fit_one, targets: list, parallel: int = 2) -> list:
    """Run ``fit_one(target)`` for every target, ``parallel`` at a time: the fits are
    independent Spark jobs and the scheduler runs them side by side."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(fit_one, targets))


def auc(scored: DataFrame, label: str, score_col: str = "score") -> float:
    """ACTION. Exact ROC AUC (ties count half), computed distributed by Spark ML."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=score_col, labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(scored.select(F.col(score_col).cast("double").alias(score_col),
                                     F.col(label).cast("double").alias(label)))


# Rank-sum AUC: the most distinct scores one window ranks, and the most score buckets
# (cut at approximate quantiles, so the buckets are balanced).
AUC_BUCKET_ROWS = 2_000_000
AUC_MAX_BUCKETS = 4096


def auc_frame(scored: DataFrame, label: str, score_col: str = "score",
              bucket_rows: int = AUC_BUCKET_ROWS) -> DataFrame:
    """Exact ROC AUC as a one-row DataFrame ``auc`` (ties count half), by the rank sum
    ``sum over scores of pos * (neg below + neg / 2) / (P * N)`` in integer counts.

    One row per distinct score (map-side partial counts), checkpointed: the input is
    scanned once. The negatives below each score are a prefix sum. Distinct scores fall
    into ranges of about ``bucket_rows`` each, cut at approximate quantiles (ACTIONS: a
    count, then, only when there is more than one range, one small aggregate whose cut
    points come back as literals). The range totals (a few thousand rows at most) are
    summed in order, and a window inside each range adds the rest, so no task ranks more
    than about ``bucket_rows`` scores. A NaN score ranks above all others. Null for a
    single class."""
    y = F.col(label).cast("int")
    g = (scored.where(F.col(score_col).isNotNull() & F.col(label).isNotNull())
         .groupBy(F.col(score_col).cast("double").alias("_s"))
         .agg(F.sum(F.when(y == 1, 1).otherwise(0)).cast("long").alias("_pos"),
              F.sum(F.when(y == 0, 1).otherwise(0)).cast("long").alias("_neg")))
    # the per-score counts are read several times: written once to the checkpoint
    # folder, the input is scanned once
    checkpoint_dir(scored.sparkSession)
    g = g.checkpoint(eager=True)
    buckets = min(AUC_MAX_BUCKETS, math.ceil(g.count() / bucket_rows))
    cuts = []
    if buckets > 1:
        probs = [i / buckets for i in range(1, buckets)]
        cuts = g.agg(F.percentile_approx("_s", probs, 10 * buckets)).first()[0] or []
    splits = [-math.inf, *sorted(set(float(c) for c in cuts)), math.inf]
    if len(splits) > 2:
        g = Bucketizer(splits=splits, inputCol="_s", outputCol="_b", handleInvalid="keep").transform(g)
        before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (g.groupBy("_b").agg(F.sum("_neg").alias("_bn"))        # at most AUC_MAX_BUCKETS rows
                   .select("_b", F.coalesce(F.sum("_bn").over(before), F.lit(0)).cast("long").alias("_off")))
        inside = Window.partitionBy("_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        below = F.col("_off") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))
        ranked = g.join(F.broadcast(offsets), "_b").select("_pos", "_neg", below.alias("_below"))
    else:
        # one range: at most ``bucket_rows`` distinct scores, ranked by one window
        inside = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
        ranked = g.select("_pos", "_neg", F.coalesce(F.sum("_neg").over(inside), F.lit(0)).alias("_below"))
    # in decimals: with billions of rows the products are beyond a long
    twice = F.lit(2).cast("decimal(1,0)") * F.col("_below").cast("decimal(18,0)") + F.col("_neg").cast("decimal(18,0)")
    t = ranked.agg(F.sum((F.col("_pos").cast("decimal(18,0)") * twice).cast("decimal(38,0)")).alias("_num2"),
                   F.sum("_pos").cast("double").alias("_p"), F.sum("_neg").cast("double").alias("_n"))
    return t.select(F.try_divide(F.col("_num2").cast("double"), F.lit(2.0) * F.col("_p") * F.col("_n")).alias("auc"))


def class_report(pred: DataFrame, label: str, prediction: str = "prediction",
                 classes: tuple = (0, 1)) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy, macro and weighted
    averages (the rows a classification report has). Built from one confusion-count
    aggregate; lazy."""
    conf = pred.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).count()
    aggs = [F.sum("count").alias("n"), F.sum(F.when(F.col("y") == F.col("p"), F.col("count"))).alias("hit")]
    for c in classes:
        aggs += [F.sum(F.when((F.col("y") == c) & (F.col("p") == c), F.col("count"))).alias(f"tp{c}"),
                 F.sum(F.when(F.col("p") == c, F.col("count"))).alias(f"pp{c}"),
                 F.sum(F.when(F.col("y") == c, F.col("count"))).alias(f"sp{c}")]
    t = conf.agg(*aggs).na.fill(0)

    def metrics(c):
        tp, pp, sp = F.col(f"tp{c}").cast("double"), F.col(f"pp{c}"), F.col(f"sp{c}")
        prec = F.when(pp > 0, tp / pp).otherwise(F.lit(0.0))
        rec = F.when(sp > 0, tp / sp).otherwise(F.lit(0.0))
        f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        return prec, rec, f1, sp

    ms = {c: metrics(c) for c in classes}
    k = float(len(classes))
    support = sum((ms[c][3] for c in classes[1:]), ms[classes[0]][3])

    def avg(i):
        return sum((ms[c][i] for c in classes[1:]), ms[classes[0]][i]) / F.lit(k)

    def wavg(i):
        return sum((ms[c][i] * ms[c][3] for c in classes[1:]), ms[classes[0]][i] * ms[classes[0]][3]) / F.nullif(support, F.lit(0))

    def row(name, p, r, f, n):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        n.cast("bigint").alias("support"))

    none = F.lit(None)
    rows = [row(str(c), *ms[c]) for c in classes]
    rows += [row("accuracy", none, none, F.try_divide("hit", "n"), F.col("n")),
             row("macro avg", avg(0), avg(1), avg(2), F.col("n")),
             row("weighted avg", wavg(0), wavg(1), wavg(2), F.col("n"))]
    # the one-row aggregate is evaluated once; its report rows come out of one explode
    return t.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def save_model(model: PipelineModel, path: str) -> None:
    """ACTION. Overwrite-safe model save (rerun replaces)."""
    model.write().overwrite().save(path)


def save_report(report: DataFrame, path: str) -> None:
    """ACTION. The report is data: written as Parquet, not through a driver file handle."""
    report.coalesce(1).write.mode("overwrite").parquet(path)
