"""End to end on the smallest driver tables: entry(), the three jobs, the
published-table queries, and plan shape checks."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) >= {"policy", "value_at_risk"}
    assert all(r.targeted_count >= 1 for r in rows)


def test_every_query_has_unique_names_and_oracles_are_subset():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


def test_feature_plan_shuffles(spark):
    from retentia.operators.features import feature_table
    from retentia.operators.grains import invoice_rollup
    from retentia.sources.tables import transactions
    inv = invoice_rollup(transactions(spark, SF_SMALL))
    plan = feature_table(inv)._jdf.queryExecution().executedPlan().toString()
    # windows run on (CustomerID, bucket) partitions, never on a single partition
    assert "SinglePartition" not in plan
    assert "_part" in plan
    # the event path has exactly one exchange keyed by (CustomerID, _part) ahead of the windows
    assert plan.count("REPARTITION_BY_COL") == 1


def test_jobs_end_to_end(spark):
    from retentia.config import SplitConfig
    from retentia.plans import jobs, tables
    from retentia.sources.tables import transactions
    base = tempfile.mkdtemp(prefix="retentia-jobs-")
    jobs.build_features_job(spark, transactions(spark, SF_SMALL), base)
    jobs.train_job(spark, base, SplitConfig(), model_specs={"logistic_regression": {}, "lightgbm": {"n_estimators": 3}},
                   backtest=False)
    jobs.score_job(spark, base)
    assert tables.champion(spark, base)["source"] == "promotion"
    t = tables.targets(spark, base, 10, 5).collect()
    assert 1 <= len(t) <= 5
    assert tables.predictions(spark, base, 3).count() == 3
    assert tables.drift_latest(spark, base).count() == 9
    assert tables.drift_history(spark, base).count() == 1
    assert tables.model_comparison(spark, base).count() == 2
    assert tables.load_predictions(spark, base).count() > 0
    with pytest.raises(ValueError):
        tables.load_predictions(spark, base, ["not_a_column"])
    exp = tables.simulate_experiment(spark, base, [0.1]).first()
    assert exp.targeted_customers >= 1
    from retentia.sources import sinks as S
    last = S.read_published(spark, base, "feature_table", "build_features").agg(F.max("invoice_month")).first()[0]
    jobs.score_job(spark, base, as_of_month=f"{last:%Y-%m}")
    months = S.read_published(spark, base, "predictions", "score").select("invoice_month").distinct().collect()
    assert [m[0] for m in months] == [last]
    with pytest.raises(ValueError):
        tables.predictions(spark, base, 3, sort_by="nope")


def test_a_run_done_again_replaces_its_rows_and_a_dead_one_shows_nothing(spark):
    from retentia.operators.monitor import history_trend
    from retentia.sources import sinks as S
    base = tempfile.mkdtemp(prefix="retentia-runs-")
    row = "generated_at_utc string, top_psi double"

    def run(run_id, at, psi, publish=True):
        S.write_table(spark.createDataFrame([(psi,)], "psi double"), base, "report", run_id)
        if not publish:  # the job dies between its tables and its publication
            return
        S.publish_run(spark, base, run_id, "score", ["report"])
        S.append_history(spark.createDataFrame([(at, psi)], row), base, run_id)

    assert S.load_history(spark, base) is None
    run("r1", "2024-01-01", 0.1)
    run("r2", "2024-01-02", 0.3)
    run("r1", "2024-01-01", 0.2)
    run("r3", "2024-01-03", 0.9, publish=False)
    history = S.load_history(spark, base)
    assert sorted((r.run_id, r.top_psi) for r in history.collect()) == [("r1", 0.2), ("r2", 0.3)]
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{base}/{S.PUBLISHED}").count() == 2
    assert S.latest_run(spark, base, "score") == "r1"  # published last
    assert S.read_published(spark, base, "report", "score").first().psi == 0.2
    trend = {r.run_id: r.psi_change for r in history_trend(history).collect()}
    assert trend["r1"] is None and abs(trend["r2"] - 0.1) < 1e-9


def test_preaggregated_invoices_equal_line_rollup(spark):
    from retentia.operators.grains import invoice_rollup
    from retentia.sources.tables import invoices, transactions
    a = invoice_rollup(transactions(spark, SF_SMALL)).toPandas().sort_values("Invoice").reset_index(drop=True)
    b = invoices(spark, SF_SMALL).toPandas().sort_values("Invoice").reset_index(drop=True)
    assert len(a) == len(b)
    assert (a.Invoice.values == b.Invoice.values).all() and (a.num_lines.values == b.num_lines.values).all()
    assert abs(a.invoice_total_revenue - b.invoice_total_revenue).max() < 1e-6


def test_streaming_rollup(spark):
    import __spark_entry__ as E
    out = E.queries()["streaming_purchase_rollup"](spark, SF_SMALL)
    rows = out.collect()
    assert len(rows) > 0 and all(r.n_events >= 1 for r in rows)


def test_raw_csv_through_build_job(spark):
    from retentia.plans import jobs
    from retentia.sources import sinks as S
    from retentia.sources.tables import load_raw_csv
    d = tempfile.mkdtemp(prefix="retentia-csv-")
    path = os.path.join(d, "raw.csv")
    lines = ["Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"]
    for i in range(40):
        cust = 13000 + i % 4
        lines.append(f"{500 + i},A{i},Crème brûlée set,{(i % 5) + 1},2010-{1 + i % 12:02d}-0{1 + i % 9} 10:00:00,2.5,{cust}.0,France")
    lines.append("999,B,bad qty,abc,2010-01-01 10:00:00,1.0,13001.0,France")
    lines.append("998,B,bad date,1,not-a-date,1.0,13001.0,France")
    with open(path, "w", encoding="latin-1") as f:
        f.write("\n".join(lines) + "\n")
    raw = load_raw_csv(spark, path)
    assert raw.filter(F.col("Description").contains("brûlée")).count() == 40
    base = os.path.join(d, "out")
    jobs.build_features_job(spark, raw, base)
    ft = S.read_published(spark, base, "feature_table", "build_features")
    assert ft.select("CustomerID").distinct().count() == 4
    clean = S.read_published(spark, base, "transactions_clean", "build_features")
    assert clean.count() == 40  # both bad rows dropped
    with pytest.raises(FileNotFoundError):
        load_raw_csv(spark, os.path.join(d, "missing.csv"))
