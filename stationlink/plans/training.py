"""Training: targets above the threshold -> IQR filter on the features -> per target:
replicate by count, balance, split, scale + boosted trees, metrics, saved model and
report. The loop is over targets (a handful); every step inside is a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import model
from ..schemas import FEATURES, SEED, TARGET_MIN_TOTAL, TARGETS
from ..session import checkpoint_dir


def train_targets(panel: DataFrame, id_cols: tuple = ("newdate", "stnNm"), features=FEATURES, targets=TARGETS,
                  threshold: float = TARGET_MIN_TOTAL, out_dir: str | None = None, params: dict | None = None,
                  parallel: int = 2, skipped: dict | None = None) -> DataFrame:
    """ACTION. Returns one report row per (target, class/average) with ``auc`` alongside.
    A target that cannot be trained (a class missing after balancing, or on either side
    of the split) is skipped; ``skipped`` takes the reason, and with ``out_dir`` it is
    written to ``<target>_skipped``. The panel is read twice: for the sums and for the
    filtered rows, which are checkpointed for all targets."""
    spark = panel.sparkSession
    checkpoint_dir(spark)
    skipped = {} if skipped is None else skipped
    present = [t for t in targets if t in panel.columns]
    keep = [r.target for r in feat.select_targets(panel, present, threshold).collect()]  # <= len(targets) rows
    if not keep:
        return spark.createDataFrame([], "target string, class string, precision double, recall double, "
                                         "f1 double, support bigint, auc double")
    pre = feat.iqr_filter(panel.select(*[F.col(f"`{c}`") for c in list(id_cols) + list(features) + keep]),
                          list(features)).checkpoint(eager=True)

    def skip(target, reason):
        skipped[target] = reason
        if out_dir:
            model.save_report(spark.createDataFrame([(target, reason)], "target string, reason string"), f"{out_dir}/{target}_skipped")

    def one(target):
        rows = feat.prepare_target(pre, list(features), target, id_cols=id_cols)
        bal = feat.undersample(rows, target, list(id_cols) + ["copy"], seed=SEED)
        # balanced rows are few: every step after this one starts from them
        bal = bal.checkpoint(eager=True)
        if bal.isEmpty():
            return skip(target, "one class only")
        sp = feat.split_train_test(bal, target, list(id_cols) + ["copy"], 0.2, SEED).checkpoint(eager=True)
        sides = {(r.split, r[target]) for r in sp.select("split", target).distinct().collect()}    # at most 4
        missing = [f"no row of class {c} to {side}" for side in ("train", "test") for c in (0, 1) if (side, c) not in sides]
        if missing:
            return skip(target, "; ".join(missing))
        m, scored = model.fit_and_score(sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test"),
                                        list(features), target, params)
        a = model.auc(scored, target)
        rep = model.class_report(scored, target).select(F.lit(target).alias("target"), "*",
                                                         F.lit(a).alias("auc"))
        if out_dir:
            model.save_model(m, f"{out_dir}/{target}_model")
            model.save_report(rep, f"{out_dir}/{target}_report")
        return rep

    reps = [r for r in model.fit_per_target(one, keep, parallel) if r is not None]
    out = reps[0] if reps else None
    for r in reps[1:]:
        out = out.unionByName(r)
    return out if out is not None else spark.createDataFrame(
        [], "target string, class string, precision double, recall double, f1 double, support bigint, auc double")
