"""A loan-shaped view over the order tables, with a planted credit signal.

The same SQL text runs in Spark and in DuckDB; only the hex formatter differs. The outcome comes
from a hash of the order key, so it is deterministic; splits and samples use other hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoremill.operators.cleaning import clean
from scoremill.operators.target import add_target
from scoremill.sources.staging import stage

TABLES = ("orders", "customer", "nation", "lineitem")
TARGET = "default_status"
KEY = "loan_id"

LOAN_SQL = """
items AS (
  SELECT l_orderkey, count(*) AS n_items, round(avg(l_discount), 6) AS avg_disc,
         sum(l_quantity) AS sum_qty
  FROM {lineitem} GROUP BY l_orderkey),
base AS (
  SELECT o_orderkey AS loan_id, o_custkey AS member_id, o_totalprice AS loan_amnt,
         c_acctbal AS annual_inc, n_items, avg_disc, sum_qty,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'B' WHEN '3' THEN 'C'
              WHEN '4' THEN 'D' ELSE 'E' END AS grade,
         CAST(substr(o_orderpriority, 1, 1) AS int) AS g, o_orderstatus AS os,
         c_mktsegment AS purpose, n_name AS addr_state, c_name, o_orderdate AS issue_d,
         md5(concat(CAST(o_orderkey AS string), '|42')) AS h
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
  LEFT JOIN items ON l_orderkey = o_orderkey),
outcome AS (
  SELECT *, CASE WHEN substr(h, 1, 2) < {hex2}(20 + 18 * (g - 1)
              + CASE WHEN coalesce(sum_qty, 0) > 130 THEN 45 ELSE 0 END
              + CASE WHEN annual_inc < 1500 THEN 30 ELSE 0 END
              + CASE WHEN loan_amnt > 400000 THEN 15 ELSE 0 END) THEN 1 ELSE 0 END AS bad_raw
  FROM base),
loans AS (
  SELECT loan_id, loan_id AS id, member_id,
    CASE WHEN bad_raw = 1 AND substr(h, 3, 1) < 'c' THEN 'Charged Off'
         WHEN bad_raw = 1 AND substr(h, 3, 1) < 'e' THEN 'Default'
         WHEN bad_raw = 1 THEN 'Late (31-120 days)'
         WHEN os = 'P' AND substr(h, 3, 1) < 'c' THEN 'Current'
         WHEN os = 'P' THEN 'In Grace Period' ELSE 'Fully Paid' END AS loan_status,
    loan_amnt, annual_inc, n_items, avg_disc, sum_qty, grade, purpose, addr_state, issue_d,
    CASE WHEN substr(h, 4, 1) < '3' THEN NULL ELSE c_name END AS emp_title,
    CAST(5 + 3 * g AS double) + 20 * avg_disc AS int_rate,
    sum_qty / 8e0 AS dti,
    CASE WHEN n_items > 4 THEN ' 60 months' ELSE ' 36 months' END AS term,
    CASE WHEN n_items IS NULL THEN NULL
         ELSE concat(CAST(n_items AS string), ' years') END AS emp_length,
    CASE WHEN substr(h, 5, 1) < '2' THEN NULL WHEN substr(h, 5, 1) < '9' THEN 'MORTGAGE'
         WHEN substr(h, 5, 1) < 'd' THEN 'RENT' ELSE 'OWN' END AS home_ownership,
    CASE WHEN substr(h, 6, 1) < '8' THEN NULL
         ELSE CAST(g * 12 + n_items AS double) END AS mths_since_last_delinq,
    CASE WHEN substr(h, 7, 1) = '0' THEN NULL ELSE avg_disc * 1000 END AS revol_util,
    loan_amnt AS funded_amnt, loan_amnt / 36e0 AS installment,
    loan_amnt * (1 - bad_raw * 0.5e0) AS total_pymnt, bad_raw * 0.1e0 AS recoveries,
    CAST(NULL AS double) AS dti_joint, 'n' AS pymnt_plan
  FROM outcome)
"""

LOAN_COLUMNS = (
    "loan_id", "id", "member_id", "loan_status", "loan_amnt", "annual_inc", "n_items", "avg_disc",
    "sum_qty", "grade", "purpose", "addr_state", "issue_d", "emp_title", "int_rate", "dti", "term",
    "emp_length", "home_ownership", "mths_since_last_delinq", "revol_util", "funded_amnt",
    "installment", "total_pymnt", "recoveries", "dti_joint", "pymnt_plan")

# By session, input files and label: changed input is staged anew.
_staged: dict[tuple[str, str, str], DataFrame] = {}


def loan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view itself, unstaged."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    text = LOAN_SQL.replace("{hex2}(", "format_string('%02x', ")
    return spark.sql(f"WITH {text} SELECT * FROM loans", **tables)


def duck_loans() -> str:
    """The view's common table expressions for DuckDB."""
    return LOAN_SQL.replace("{hex2}(", "printf('%02x', ").format(**{t: t for t in TABLES})


def input_files(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the tables' files, from the file system's listing."""
    found = []
    for t in TABLES:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
        found += [f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}" for f in files]
    return "\n".join(found)


def _once(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, input_files(spark, sf_dir), label)
    if key not in _staged:
        _staged[key] = stage(build(), label, kept=True)
    return _staged[key]


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view, written once per session and state of the input files, since every query scans it repeatedly."""
    return _once(spark, sf_dir, "loans", lambda: loan_view(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled by ``all_rows`` and cleaned: the table that is profiled. Staged likewise."""
    return _once(spark, sf_dir, "cleaned", lambda: clean(
        add_target(loans(spark, sf_dir), "all_rows", target=TARGET), target=TARGET))
