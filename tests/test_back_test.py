"""The back-test of streams against that of tables."""

import pytest
from pyspark.sql import functions as F

from scoremill.operators.evaluation import metrics_by
from scoremill.plans.scorecard import PROBABILITY, fit_scorecard
from scoremill.spec import ScorecardSpec
from scoremill.streaming import back_test
from scoremill.streaming.back_test import back_test_stream, outcome_counts, period_metrics
from scoremill.streaming.scoring import read_new_files


@pytest.fixture(scope="module")
def scored(spark):
    """Loans of two years, some without a key; outcomes up to 500 days later, some doubled, some of no loan."""
    i = F.col("id")
    start = F.lit("2020-01-01").cast("timestamp")
    loans = spark.range(4000).select(
        F.when(i % 97 != 0, i).alias("id"), (F.pmod(F.xxhash64(i), F.lit(1000)) / 100.0).alias("x"),
        F.pmod(F.xxhash64(i, F.lit(1)), F.lit(7)).cast("string").alias("grade"),
        (start + F.make_dt_interval(days=F.pmod(F.xxhash64(i, F.lit(2)), F.lit(700)).cast("int"))).alias("scored_at"))
    bad = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(100)) < 10 + 6 * F.col("x")
    outcomes = (loans.withColumn("loan_status", F.when(bad, "Charged Off").otherwise("Fully Paid"))
                .withColumn("outcome_at", F.col("scored_at") + F.make_dt_interval(days=F.pmod(F.xxhash64("id", F.lit(3)), F.lit(500)).cast("int")))
                .select("id", "loan_status", "outcome_at"))
    outcomes = outcomes.unionByName(outcomes.where("id % 50 = 1")).unionByName(outcomes.where("id % 60 = 2").withColumn("id", F.col("id") + 10_000))
    labelled = loans.join(outcomes.dropDuplicates(["id"]), "id")
    spec = ScorecardSpec(key="id", policy="all_rows", features=("x", "grade"), iv_range=(0.0, 100.0))
    return fit_scorecard(labelled.select("id", "x", "grade", "loan_status"), spec), loans, outcomes


def closing(df, at):
    """A row of a time at which every period is over. Its key is there: rows without one are dropped before the time is seen."""
    return df.limit(1).withColumns({"id": F.lit(-1).cast("long"), at: F.lit("2030-01-01").cast("timestamp")})


def test_streams_in_several_batches_equal_the_tables(spark, scored, tmp_path):
    """Files come month after month; the last ones say that all periods are over."""
    model, loans, outcomes = scored
    folders = {name: str(tmp_path / name) for name in ("loans", "outcomes")}
    for name, df, at in (("loans", loans, "scored_at"), ("outcomes", outcomes, "outcome_at")):
        for months in range(0, 48, 12):
            part = F.months_between(at, F.lit("2020-01-01"))
            df.where((part >= months) & (part < months + 12)).coalesce(1).write.mode("append").parquet(folders[name])
        closing(df, at).write.mode("append").parquet(folders[name])
    out, checkpoint = str(tmp_path / "counts"), str(tmp_path / "checkpoint")
    streams = [read_new_files(spark, folders[n], spark.read.parquet(folders[n]).schema, files_per_batch=2) for n in ("loans", "outcomes")]
    query = back_test_stream(model, *streams, out, checkpoint, once=True, late="800 days")
    query.awaitTermination(300)
    assert query.exception() is None and len(query.recentProgress) > 2
    pairs = (model.transform(loans).withColumn("score", F.round(PROBABILITY, 6)).join(outcomes, "id")
             .where("outcome_at >= scored_at AND outcome_at <= scored_at + INTERVAL 365 days")
             .withColumn("period", F.window("outcome_at", "30 days")["start"]).withColumn("y", (F.col("loan_status") == "Charged Off").cast("int")))
    want = sorted(map(tuple, metrics_by(pairs, ["period"], target="y").collect()))
    found = sorted(map(tuple, period_metrics(spark, out).collect()))
    assert len(found) == len(want) > 20
    for a, b in zip(found, want):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=1e-12)


def test_a_restarted_stream_goes_on_where_it_stopped(spark, scored, tmp_path):
    model, loans, outcomes = scored
    names = {n: str(tmp_path / n) for n in ("loans", "outcomes", "counts", "checkpoint")}
    run = lambda: back_test_stream(model, *[read_new_files(spark, names[n], df.schema) for n, df in (("loans", loans), ("outcomes", outcomes))],
                                   names["counts"], names["checkpoint"], once=True, late="800 days").awaitTermination(300)
    loans.write.parquet(names["loans"])
    outcomes.limit(0).write.parquet(names["outcomes"])
    run()
    outcomes.write.mode("append").parquet(names["outcomes"])
    closing(loans, "scored_at").write.mode("append").parquet(names["loans"])
    closing(outcomes, "outcome_at").write.mode("append").parquet(names["outcomes"])
    run()
    table = outcome_counts(model.transform(loans), outcomes, "id")
    assert sorted(map(tuple, spark.read.parquet(names["counts"]).collect())) == sorted(map(tuple, table.collect()))


def test_what_waits_is_not_held_as_objects(spark, scored, tmp_path):
    """The state lies in RocksDB, unless the session names another store; the session's settings stay as they are."""
    model, loans, outcomes = scored
    names = {n: str(tmp_path / n) for n in ("loans", "outcomes")}
    loans.write.parquet(names["loans"])
    outcomes.write.parquet(names["outcomes"])
    before = [spark.conf.get(c, None) for c in (back_test.STORE, back_test.CHANGELOG)]
    query = back_test_stream(model, *[read_new_files(spark, names[n], df.schema) for n, df in (("loans", loans), ("outcomes", outcomes))],
                             str(tmp_path / "counts"), str(tmp_path / "checkpoint"), once=True, late="800 days")
    query.awaitTermination(300)
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert states and all(any(m.startswith("rocksdb") for m in s["customMetrics"]) for s in states)
    assert before == [spark.conf.get(c, None) for c in (back_test.STORE, back_test.CHANGELOG)]


def test_rows_that_wait_are_not_counted_and_lie_in_parts_of_a_size(spark, scored, tmp_path, monkeypatch):
    """Two lookups a row at most in the state, three with the counting, and more parts for more rows; counts and settings stay."""
    monkeypatch.setattr(back_test, "IN_PART", 500)
    model, loans, outcomes = scored
    names = {n: str(tmp_path / n) for n in ("loans", "outcomes")}
    loans.write.parquet(names["loans"])
    outcomes.unionByName(closing(outcomes, "outcome_at")).write.parquet(names["outcomes"])
    closing(loans, "scored_at").write.mode("append").parquet(names["loans"])
    before = [spark.conf.get(c, None) for c in (back_test.COUNTED, back_test.BUFFER, back_test.PARTITIONS)]
    query = back_test_stream(model, *[read_new_files(spark, names[n], df.schema) for n, df in (("loans", loans), ("outcomes", outcomes))],
                             str(tmp_path / "counts"), str(tmp_path / "checkpoint"), once=True, waiting=5800, late="800 days")
    query.awaitTermination(300)
    assert before == [spark.conf.get(c, None) for c in (back_test.COUNTED, back_test.BUFFER, back_test.PARTITIONS)]
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert {s["numShufflePartitions"] for s in states} == {12} and int(before[2]) < 12
    metrics = next(s["customMetrics"] for s in states if s["operatorName"] == "symmetricHashJoin")
    assert 0 < metrics["rocksdbGetCount"] <= 1.2 * metrics["rocksdbPutCount"]
    table = outcome_counts(model.transform(loans), outcomes, "id")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "counts")).collect())) == sorted(map(tuple, table.collect()))
