"""Command line for a daily run (the reference's per-job ``main(date)``).

    spark-submit -m pomelo.plans.daily --date 20171028 --out-root <shared dir> \\
        --inputs '{"item_dim": "db.items", "behavior": "db.behaviour", ...}' \\
        --jobs feature,label,decode,agreement,train,validation

``--inputs`` maps the input names of ``sources.fixtures.Inputs`` to catalog
tables (with the columns listed in FIXTURES.md); ``device_user_twin``, the
device table of the known-label twin, is ``device_user`` unless given. 
``--sf-dir`` derives them from the synthetic test tables instead.  Dates go through the
lenient normalisation (D1).  The agreement day, the reference year and the
new snapshot follow the run date unless given; job ``drift`` (not run by
default) needs ``--snapshot-old`` and ``--drift-items``.

Jobs ``train`` and ``validation`` read what the other jobs have written for
the run date and fail where that is missing; ``--derive-missing`` lets them
derive it from the raw inputs instead, and the job log says so.

Checkpoints go to ``spark.checkpoint.dir``, or to a folder under
``--out-root`` where that is unset; they are removed when the run ends.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from pomelo import params as P
from pomelo.functions.dates import normalise_run_date_py
from pomelo.plans import jobs as J
from pomelo.session import delete_folder
from pomelo.sources import fixtures as FX

JOBS = {
    "feature": J.feature_build,
    "label": J.label_build,
    "decode": J.decode_build,
    "agreement": J.agreement,
    "train": J.train_publish,
    "validation": J.validation,
}


def inputs_from_catalog(spark: SparkSession, names: dict[str, str]) -> FX.Inputs:
    fields = [f.name for f in dataclasses.fields(FX.Inputs) if f.name != "truth_table"]
    if "device_user" in names:
        names = {"device_user_twin": names["device_user"], **names}
    missing = [f for f in fields if f not in names]
    if missing:
        raise ValueError(f"--inputs lacks {missing}")
    truth = names["truth_full"]
    parts = [c.name for c in spark.catalog.listColumns(truth) if c.isPartition]
    return FX.Inputs(**{f: spark.table(names[f]) for f in fields}, truth_table=truth if parts == ["stat_date"] else None)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--date", required=True)
    ap.add_argument("--out-root", required=True, help="shared folder for the output tables")
    ap.add_argument("--inputs", help="JSON map input name -> catalog table")
    ap.add_argument("--sf-dir", help="derive inputs from the synthetic test tables")
    ap.add_argument("--top-k", type=int, default=P.DEFAULT_TOP_K)
    ap.add_argument("--default-threshold", action="store_true",
                    help="keep the default threshold instead of the best-F1 one")
    ap.add_argument("--agreement-date", help="day of the two label sources (default: the run date)")
    ap.add_argument("--snapshot-old", help="the earlier snapshot of the drift job")
    ap.add_argument("--drift-items", help="item ids of the drift job, comma-separated")
    ap.add_argument("--reference-year", type=int, help="year that ages are computed against (default: the run year)")
    ap.add_argument("--feature-buckets", type=int, default=P.RunParams.feature_buckets,
                    help="buckets of the feature table: its bytes / 256 MB")
    ap.add_argument("--variant", choices=("rdd", "ml"), default="rdd",
                    help="rdd: no intercept, threshold from the validation split; ml: intercept, from the training scores")
    ap.add_argument("--derive-missing", action="store_true",
                    help="derive inputs of train and validation that the other jobs have not written")
    ap.add_argument("--jobs", default=",".join(JOBS))
    a = ap.parse_args(argv)

    own_session = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName("pomelo-daily").getOrCreate()
    try:
        _run(spark, a)
    finally:
        if own_session:                              # of a session that others use, nothing is taken away
            if folder := spark.sparkContext.getCheckpointDir():
                delete_folder(spark, folder)
            spark.stop()


def _run(spark: SparkSession, a: argparse.Namespace) -> None:
    date = normalise_run_date_py(a.date)
    if not (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        spark.sparkContext.setCheckpointDir(f"{a.out_root.rstrip('/')}/checkpoints")
    other = lambda d: normalise_run_date_py(d) if d else date
    params = P.RunParams(run_date=date, label_date=date, snapshot_new=date, top_k=a.top_k,
                         select_threshold=not a.default_threshold, agreement_date=other(a.agreement_date),
                         snapshot_old=other(a.snapshot_old), reference_year=a.reference_year or int(date[:4]),
                         feature_buckets=a.feature_buckets)
    if a.inputs:
        inputs = inputs_from_catalog(spark, json.loads(a.inputs))
    elif a.sf_dir:
        inputs = FX.load_inputs(spark, a.sf_dir)
    else:
        raise SystemExit("give --inputs or --sf-dir")
    chain = (J.FittedChain.ml_variant if a.variant == "ml" else J.FittedChain)(spark, inputs, params)
    tables = J.TableNames(root=a.out_root)
    for name in a.jobs.split(","):
        if name.strip() == "drift":
            if not (a.snapshot_old and a.drift_items):
                raise SystemExit("drift needs --snapshot-old and --drift-items")
            out = J.drift(spark, chain, tables, a.drift_items.split(","))
        else:
            more = {"derive_missing": a.derive_missing} if name.strip() in ("train", "validation") else {}
            out = JOBS[name.strip()](spark, chain, tables, **more)
        if out is not None:
            out.show(truncate=False)


if __name__ == "__main__":
    main()
