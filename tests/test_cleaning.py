import pytest
from pyspark.sql import functions as F

from scoremill.operators import cleaning
from scoremill.operators.target import add_target, frequency, observed_summary, target_summary, target_totals
from scoremill.sources.staging import stage_observed

LOANS = [("Charged Off", 1), ("Default", 2), ("Late (31-120 days)", 3), ("Fully Paid", 4),
         ("Current", 5), ("In Grace Period", 6), (None, 7)]


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(LOANS, "loan_status string, id int")


def labels(df, target):
    return {r["id"]: r[target] for r in df.collect()}


def test_target_policies(loans):
    four = labels(add_target(loans, "four_status", target="y"), "y")
    assert four == {1: 1, 2: 1, 3: 1, 4: 0}
    everyone = labels(add_target(loans, "all_rows", target="y"), "y")
    assert everyone == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0, 7: 0}
    with pytest.raises(ValueError):
        add_target(loans, "other")


def test_summary_and_frequency(loans):
    row = target_summary(add_target(loans, "all_rows")).first()
    assert (row["total_rows"], row["good_loans"], row["bad_loans"], row["total_columns"]) == (7, 5, 2, 3)
    assert frequency(loans, "loan_status").count() == 6


def test_mode_takes_the_smallest_on_a_tie_and_knows_empty_columns(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), ("c", None)],
                               "x string, empty string")
    assert cleaning.mode_values(df, ["x", "empty"]) == {"x": "a", "empty": None}
    assert cleaning.fit_fills(df)["empty"] == "Unknown"


def test_median_of_an_integer_column_is_not_truncated(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    filled = cleaning.apply_fills(df, cleaning.fit_fills(df))
    assert sorted(r["n"] for r in filled.collect()) == [1.0, 1.5, 2.0]


def test_constants_win_over_medians(spark):
    df = spark.createDataFrame([(1.0, None, "x"), (None, "3 years", None), (3.0, None, "x")],
                               "mths_since_last_delinq double, emp_length string, home string")
    fills = cleaning.fit_fills(df)
    assert fills == {"mths_since_last_delinq": 999.0, "emp_length": "Unknown", "home": "x"}
    row = cleaning.residual_nulls(cleaning.apply_fills(df, fills)).first()
    assert (row["remaining_nulls"], row["complete"]) == (0, True)


def test_clean_is_idempotent(spark):
    df = spark.createDataFrame(
        [(1, "Default", 1.0, None, "n"), (2, None, None, "u", "n"), (3, "Current", 5.0, "u", "n")],
        "id int, loan_status string, income double, home string, pymnt_plan string")
    once = cleaning.clean(add_target(df, "all_rows"))
    assert once.columns == ["loan_status", "income", "home", "default_status"]
    assert sorted(map(str, cleaning.clean(once).collect())) == sorted(map(str, once.collect()))


def test_missing_profile_is_sorted_and_skips_full_columns(spark):
    df = spark.range(10).select("id", F.when(F.col("id") > 3, F.col("id")).alias("a"),
                                F.when(F.col("id") > 7, F.col("id")).alias("b"))
    rows = [tuple(r) for r in cleaning.missing_profile(df).collect()]
    assert rows == [("b", 8, 80.0), ("a", 4, 40.0)]


def test_fills_survive_storing(spark):
    fills = {"a": 1.5, "b": "x"}
    assert cleaning.fills_from_table(cleaning.fills_table(spark, fills)) == fills


def test_observed_totals_equal_the_profiles_of_a_scan(spark):
    df = add_target(spark.createDataFrame(
        [("Fully Paid", None, 1.0, "x"), ("Default", "a", None, "x"), (None, None, None, "x"), ("Current", "b", 2.0, "x")],
        "loan_status string, a string, `b.c` double, d string"))
    staged, seen = stage_observed(df, "observed", {**cleaning.null_totals(df), **target_totals()})
    nulls = {c: seen[c] for c in ["", *df.columns]}
    renamed = df.withColumnRenamed("b.c", "bc")
    same = lambda rows: [(str(r[0]).replace("b.c", "bc"), *r[1:]) for r in rows]
    assert same(cleaning.observed_missing(spark, nulls).collect()) == same(cleaning.missing_profile(renamed).collect())
    assert cleaning.observed_nulls(spark, nulls).collect() == cleaning.residual_nulls(renamed).collect()
    assert observed_summary(spark, seen, len(df.columns)).collect() == target_summary(df).collect()
    assert staged.count() == 4


def test_summary_of_no_rows(spark):
    df = spark.createDataFrame([], "default_status int")
    row = target_summary(df).first()
    assert (row["total_rows"], row["good_rate"], row["bad_rate"]) == (0, None, None)


@pytest.fixture(scope="module")
def wide(spark):
    """A leader among all-different values, two leaders that tie, no leader at all, a rare one, and no value."""
    i = F.col("id")
    other = F.concat(F.lit("v"), i.cast("string"))
    return spark.range(0, 60_000, numPartitions=5).select(
        F.when(i % 3 == 0, "leader").when(i % 7 == 0, F.lit(None)).otherwise(other).alias("led"),
        F.when(i % 4 == 0, "b").when(i % 4 == 1, "a").otherwise(other).alias("tied"),
        other.alias("flat"), F.when(i % 9_999 == 5, "rare").otherwise(other).alias("rare"),
        F.when(i < 0, other).alias("none"), (i % 3).cast("string").alias("few"))


def test_a_leading_value_is_verified_without_counting_every_value(wide, monkeypatch):
    asked = []
    full = cleaning._counted_modes
    monkeypatch.setattr(cleaning, "_counted_modes", lambda df, names: asked.extend(names) or full(df, names))
    assert cleaning.mode_values(wide, ["led", "tied", "none", "few"]) == {"led": "leader", "tied": "a", "none": None, "few": "0"}
    assert asked == []


def test_without_a_leader_every_value_is_counted(wide):
    assert cleaning.mode_values(wide, ["flat", "rare"]) == {"flat": "v0", "rare": "rare"}
    assert cleaning.mode_values(wide, ["rare", "few"], {"rare": 10**6, "few": 3}) == {"rare": "rare", "few": "0"}


@pytest.mark.parametrize("tracked", [8, 64, 12_288])
def test_modes_equal_pandas_whatever_the_sketch_tracks(spark, monkeypatch, tracked):
    monkeypatch.setattr(cleaning, "TRACKED", tracked)
    monkeypatch.setattr(cleaning, "CANDIDATES", 4)
    i = F.col("id")
    df = spark.range(0, 20_000, numPartitions=4).select(*[
        F.concat(F.lit("w"), F.floor(F.pow(F.pmod(F.xxhash64(i, F.lit(k)), F.lit(1000)) / 1000.0, power) * 300).cast("string")).alias(f"c{k}")
        for k, power in enumerate((1.0, 2.0, 6.0))])
    pdf = df.toPandas()
    assert cleaning.mode_values(df, df.columns) == {c: pdf[c].mode().min() for c in df.columns}
