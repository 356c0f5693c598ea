"""Headline-query benchmark. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each step is forced with a no-op write (full evaluation, nothing collected).
Steps follow the pipeline: the feature build reads the raw tables; later steps
read the feature table the build wrote, as the production jobs do."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from retentia.config import BUDGETS, PROJECT_DECISION, SplitConfig  # noqa: E402
from retentia.operators import evaluate as EV  # noqa: E402
from retentia.operators import monitor as M  # noqa: E402
from retentia.operators.features import feature_table  # noqa: E402
from retentia.operators.heuristics import add_heuristics, add_policy_scores, stub_probability  # noqa: E402
from retentia.operators.models import train_and_score  # noqa: E402
from retentia.operators.selection import target_flags  # noqa: E402
from retentia.operators.split import add_split  # noqa: E402
from retentia.schemas import FEATURE_COLUMNS  # noqa: E402
from retentia.session import get_spark  # noqa: E402
from retentia.sources.tables import invoices  # noqa: E402


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark("retentia-bench", master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra_conf={"spark.driver.memory": "16g"})
    scratch = tempfile.mkdtemp(prefix="retentia-bench-")
    times: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    # 1. raw tables -> invoices -> fused features (written, like the build job)
    inv_path, ft_path = os.path.join(scratch, "invoices"), os.path.join(scratch, "features")

    def build():
        invoices(spark, sf_dir).write.mode("overwrite").parquet(inv_path)
        inv = spark.read.parquet(inv_path)
        ft = feature_table(inv)
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        (ft.repartitionByRange(n, "invoice_month", "CustomerID").write.mode("overwrite")
           .partitionBy("invoice_month").parquet(ft_path))
    timed("feature_build", build)
    ft = spark.read.parquet(ft_path)

    # 2. heuristics + score + policies + global rank flags (scored table written)
    sc_path = os.path.join(scratch, "scored")

    def score():
        s = add_policy_scores(stub_probability(add_heuristics(ft)), PROJECT_DECISION)
        s = target_flags(add_split(s, SplitConfig()), "policy_net_benefit", BUDGETS)
        s.write.mode("overwrite").parquet(sc_path)
    timed("score_and_rank", score)
    sc = spark.read.parquet(sc_path)
    ev = sc.filter(F.col("split").isNotNull())

    timed("policy_evaluation", lambda: _force(EV.policy_metrics(ev, BUDGETS, group_cols=["split"])))
    timed("classification", lambda: _force(EV.classification_summary(ev, group_cols=["split"])))
    timed("segment_evaluation", lambda: _force(EV.evaluate_segments(ev.filter(F.col("split") == "test"), BUDGETS)))
    timed("decision_drift", lambda: _force(M.decision_drift(sc, BUDGETS, "policy_net_benefit")))

    def drift():
        prof = M.reference_profile(sc.filter(F.col("split") == "train"), FEATURE_COLUMNS)
        _force(M.drift_report(prof, sc, FEATURE_COLUMNS))
    timed("feature_drift", drift)

    def fit():
        train = ev.filter(F.col("split") == "train")
        scored, _ = train_and_score("logistic_regression", train, ev, FEATURE_COLUMNS)
        _force(scored)
    timed("logistic_fit_calibrate_score", fit)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
