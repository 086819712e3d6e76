import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricewright.operators.ledger import Ledger, Run
from pricewright.operators.metrics import evaluate
from pricewright.operators.models import decision_tree, least_squares, parameter_rows
from pricewright.operators.persist import load_model, save_model, score, score_and_evaluate
from pricewright.operators.split import split
from pricewright.operators.tuning import log_sweep, sweep
from pricewright.plans.pipelines import LABEL, fit_comparison_features, linear_pipeline
from pricewright.plans.training import train_linear
from pricewright.session import new_path, shared_dir
from pricewright.sources import MARKET_SCHEMA, input_files, read_market_csv, write_market_csv
from pricewright.streaming import score_files, score_stream, size_histogram
from pricewright.streaming.scoring import TELEMETRY, read_telemetry


@pytest.fixture(scope="module")
def model(small_market):
    return linear_pipeline().fit(split(small_market)[0])


@pytest.fixture(scope="module")
def uploads(spark, small_market):
    path = new_path(spark, "uploads")
    write_market_csv(small_market, path, by="region")
    return path


def test_csv_round_trip_with_and_without_inference(spark, small_market):
    path = new_path(spark, "csv")
    write_market_csv(small_market, path)
    columns = [F.col(f"`{f.name}`") for f in MARKET_SCHEMA]
    rows = small_market.select(*columns)
    back = read_market_csv(spark, path)
    assert back.exceptAll(rows).count() == 0 and rows.exceptAll(back).count() == 0
    inferred = read_market_csv(spark, path, infer=True)
    assert dict(inferred.dtypes) == dict(back.dtypes)


def test_declared_schema_must_match_the_header(spark, small_market):
    path = new_path(spark, "csv")
    swapped = small_market.select("region", "Date").limit(3)
    swapped.write.option("header", True).csv(path)
    with pytest.raises(Exception, match="header does not conform"):
        read_market_csv(spark, path).select("region").collect()


def test_saved_model_scores_the_same(spark, small_market, model):
    _, test = split(small_market)
    path = save_model(model, new_path(spark, "model"))
    again = load_model(path)
    a = sorted(r[0] for r in score(model, test).select("prediction").collect())
    assert a == sorted(r[0] for r in score(again, test).select("prediction").collect())
    with pytest.raises(PySparkException):
        save_model(model, path)
    save_model(model, path, overwrite=True)


def test_saved_comparison_model_carries_its_scaler(spark, small_market):
    train, test = split(small_market)
    features = fit_comparison_features(train)
    rows = features.transform(train).select("features", F.col(LABEL).alias("label"))
    tested = features.transform(test).select("features", F.col(LABEL).alias("label"))
    ledger = Ledger(spark, new_path(spark, "ledger"))
    trials = [("Decision Tree", decision_tree, {"max_depth": d}) for d in (2, 4)]
    result = sweep(trials, rows, tested, "label")
    parent = log_sweep(ledger, "sweep", "Parent Run", result, features)
    runs = ledger.overview().where("parent_run_id IS NOT NULL").collect()
    assert {r["parent_run_id"] for r in runs} == {parent.run_id} and len(runs) == 2
    for run in runs:
        loaded = ledger.load_model(run["run_id"])
        assert score_and_evaluate(loaded, test, LABEL).first()["rmse"] == pytest.approx(run["rmse"])


def test_ledger_finds_the_best_run_per_experiment(spark):
    ledger = Ledger(spark, new_path(spark, "ledger"))
    for experiment, values in (("a", (3.0, 1.0, 2.0)), ("b", (5.0, 5.0))):
        ledger.append(*[
            Run(experiment, f"run {i}", params={"i": i}).finish(rmse=v, r2=-v)
            for i, v in enumerate(values)
        ])
    best = {r["experiment"]: r["name"] for r in ledger.best("rmse").collect()}
    assert best == {"a": "run 1", "b": "run 0"}
    assert {r["name"] for r in ledger.best("r2", largest=True).collect()} == {"run 1", "run 0"}
    assert ledger.params().count() == 5 and ledger.runs().where("ended < started").count() == 0


def test_training_logs_what_it_saved(spark, small_market):
    train, test = split(small_market)
    ledger = Ledger(spark, new_path(spark, "ledger"))
    trained = train_linear(train, test, ledger, folds=3)
    run = ledger.overview().first()
    last = ledger.load_model(run["run_id"]).stages[-1]
    assert float(run["params"]["regParam"]) == last.getRegParam() == trained.params["regParam"]
    assert run["rmse"] == pytest.approx(trained.metrics.first()["rmse"])


def test_parameters_are_listed_with_their_meaning(spark):
    rows = {r["param"]: r for r in parameter_rows(spark, least_squares()).collect()}
    assert rows["regParam"]["value"] == "0.0" and rows["regParam"]["doc"]
    assert rows["weightCol"]["value"] is None


def test_stream_equals_batch_whatever_the_batch_size(spark, small_market, model, uploads):
    want = evaluate(model.transform(small_market), LABEL).first()
    for max_files in (None, 3):
        target = new_path(spark, "scored")
        out = score_stream(spark, model, uploads, target, max_files=max_files)
        scored = spark.read.parquet(out.predictions)
        assert scored.count() == small_market.count()
        assert evaluate(scored, LABEL).first()["rmse"] == pytest.approx(want["rmse"])
        telemetry = read_telemetry(spark, out)
        assert telemetry.columns == list(TELEMETRY)
        files = input_files(spark, uploads).where("path LIKE '%.csv'").count()
        assert telemetry.count() == files
        total = telemetry.agg(F.sum("rows"), F.min("seconds"), F.min("micros_per_row")).first()
        assert total[0] == small_market.count() and total[1] > 0 and total[2] > 0


def test_stream_scores_only_new_files(spark, small_market, model):
    source, target = new_path(spark, "uploads"), new_path(spark, "scored")
    part = small_market.limit(40).select(*[F.col(f"`{f.name}`") for f in MARKET_SCHEMA])
    for n in (1, 2):
        part.coalesce(1).write.mode("append").option("header", True).csv(source)
        out = score_stream(spark, model, source, target)
        assert spark.read.parquet(out.predictions).count() == 40 * n


def test_batch_scoring_lists_empty_files(spark, small_market, model):
    source = new_path(spark, "uploads")
    columns = [F.col(f"`{f.name}`") for f in MARKET_SCHEMA]
    for rows in (small_market.select(*columns).limit(20), small_market.select(*columns).limit(0)):
        rows.coalesce(1).write.mode("append").option("header", True).csv(source)
    out = score_files(spark, model, source, new_path(spark, "scored")).where(
        "file LIKE '%.csv'"
    ).orderBy("rows").collect()
    assert [r["rows"] for r in out] == [0, 20]
    assert out[0]["micros_per_row"] is None and out[0]["mae"] is None
    assert out[1]["micros_per_row"] > 0


def test_stream_lists_empty_files_once(spark, small_market, model):
    source, target = new_path(spark, "uploads"), new_path(spark, "scored")
    columns = [F.col(f"`{f.name}`") for f in MARKET_SCHEMA]
    for n in (20, 0):
        small_market.select(*columns).limit(n).coalesce(1).write.mode("append").option(
            "header", True).csv(source)
    for _ in range(2):
        out = score_stream(spark, model, source, target)
        rows = read_telemetry(spark, out).orderBy("rows").collect()
        assert [r["rows"] for r in rows] == [0, 20]
        assert rows[0]["batch_id"] == -1 and rows[0]["bytes"] > 0 and rows[0]["mae"] is None


def test_size_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 100, 101, 10_000, 10_001)], "n bigint")
    rows = {r["up_to"]: (r["count"], r["cumulative"]) for r in size_histogram(df, "n").collect()}
    assert rows == {0: (1, 1), 100: (2, 3), 1000: (1, 4), 10000: (1, 5), None: (1, 6)}


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark) == named
    assert new_path(spark, "a") != new_path(spark, "a")


def test_ledger_finds_any_metric_and_repeated_appends(spark):
    ledger = Ledger(spark, new_path(spark, "ledger"))
    runs = [Run("e", n, params={"a": 1}).finish(avg_rmse=v) for n, v in (("x", 2.0), ("y", 1.0))]
    ledger.append(*runs)
    ledger.append(*runs)
    assert [(r["name"], r["avg_rmse"]) for r in ledger.best("avg_rmse").collect()] == [("y", 1.0)]
    assert ledger.overview().count() == 2
