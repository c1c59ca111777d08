"""DuckDB SQL for every registered query that SQL can state, on the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from scoremill_checks.loan_view import LOAN_COLUMNS, duck_loans
from scoremill_checks.queries import (
    ALL_NUMBERS, ALL_TEXTS, CATEGORIES, CORRELATED, LOAN_NUMBERS, NEW_LOANS_FROM, NUMBERS, PROFILED, ROW_COLUMNS, SAMPLE, STUMP)

FOUR_KEPT = "('Charged Off', 'Default', 'Late (31-120 days)', 'Fully Paid')"
FOUR_BAD = "('Charged Off', 'Default', 'Late (31-120 days)')"
ALL_BAD = "('Charged Off', 'Default')"
FEATURES = NUMBERS + CATEGORIES
# 20 points double the odds; 600 points are odds of 50 to 1.
FACTOR = "(20e0 / ln(2e0))"
OFFSET = f"(600e0 - {FACTOR} * ln(50e0))"
SELECTED_RANGE = "iv >= 0.02e0 AND iv < 0.5e0"


def tidy(expression: str, digits: int = 6) -> str:
    """Round and turn -0 into 0."""
    return f"CASE WHEN round({expression}, {digits}) = 0 THEN 0e0 ELSE round({expression}, {digits}) END"


def cols(names: Sequence[str], template: str, joiner: str = ", ") -> str:
    return joiner.join(template.format(c=c) for c in names)


def with_loans(*ctes: str) -> str:
    return "WITH " + ",\n".join([duck_loans().strip(), *ctes]) + "\n"


def labelled(policy: str = "four_status", name: str = "lab", source: str = "loans") -> str:
    bad = FOUR_BAD if policy == "four_status" else ALL_BAD
    where = f"WHERE loan_status IN {FOUR_KEPT}" if policy == "four_status" else ""
    return (f"{name} AS (SELECT *, CASE WHEN loan_status IN {bad} THEN 1 ELSE 0 END AS y "
            f"FROM {source} {where})")


def split(share: str = "0.2e0", source: str = "lab") -> list[str]:
    """Exact stratified test flag by hash order."""
    return [
        f"class_size AS (SELECT y, count(*) AS n FROM {source} GROUP BY y)",
        f"""class_share AS (
  SELECT y, n, (n * train)::DOUBLE / total AS exact, train FROM class_size,
    (SELECT sum(n) AS total, sum(n) - ceil({share} * sum(n)) AS train FROM class_size))""",
        """class_test AS (
  SELECT y, n - floor(exact)
    - CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, y)
                <= train - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS n_test FROM class_share)""",
        f"""flagged AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.y ORDER BY
    md5(concat(CAST(loan_id AS string), '|split|42')), loan_id) <= n_test AS is_test
  FROM {source} l JOIN class_test c ON l.y = c.y)"""]


def fills(names: Sequence[str], source: str, modes: Sequence[str] = (), prefix: str = "") -> list[str]:
    """Medians of numbers and most frequent texts of a source, one row."""
    mode = "(SELECT {c} FROM " + source + " WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS {c}"
    return [f"{prefix}med AS (SELECT {cols(names, 'quantile_cont({c}, 0.5) AS {c}')} FROM {source})",
            f"{prefix}top AS (SELECT {cols(modes, mode)})" if modes else f"{prefix}top AS (SELECT 1 AS one)"]


def weights(fit: str, apply: str, numbers: Sequence[str] = NUMBERS,
            categories: Sequence[str] = CATEGORIES, key: str = "loan_id",
            keep: str = "y", fill: bool = True) -> list[str]:
    """Bins and weights fitted on one source, and another source's rows with their bins.

    ``w`` holds feature, bin_id, category and the weights; ``cells`` holds key, feature and weight
    per applied row.
    """
    ctes = []
    if fill:
        ctes += fills(numbers, fit, categories)
        number = "coalesce(CAST(s.{c} AS DOUBLE), med.{c}) AS {c}"
        text = "coalesce(s.{c}, top.{c}) AS {c}"
        tail = ", med, top"
    else:
        number, text, tail = "CAST(s.{c} AS DOUBLE) AS {c}", "s.{c} AS {c}", ""
    for name, source in (("fit_rows", fit), ("apply_rows", apply)):
        ctes.append(f"{name} AS (SELECT s.{key}, s.{keep}, {cols(numbers, number)}, "
                    f"{cols(categories, text)} FROM {source} s{tail})")
        ctes.append(f"{name}_n AS (" + " UNION ALL ".join(
            f"SELECT {key}, {keep}, '{c}' AS feature, {c} AS x FROM {name}" for c in numbers) + ")")
        ctes.append(f"{name}_c AS (" + " UNION ALL ".join(
            f"SELECT {key}, {keep}, '{c}' AS feature, {c} AS v FROM {name}" for c in categories) + ")")
    ctes.append("""edges AS (
  SELECT feature, count(DISTINCT x) AS d, list_sort(list_distinct(quantile_cont(x,
    [0e0, 0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0, 1e0]))) AS e
  FROM fit_rows_n WHERE x IS NOT NULL GROUP BY feature)""")
    ctes.append("""few AS (
  SELECT feature, count(DISTINCT v) AS d FROM fit_rows_c GROUP BY feature HAVING count(DISTINCT v) <= 100)""")
    for name in ("fit_rows", "apply_rows"):
        ctes.append(f"""{name}_b AS (
  SELECT {key}, {keep}, n.feature, CASE WHEN x IS NULL OR d <= 10 THEN NULL
      ELSE len(list_filter(e[2:len(e) - 1], lambda t: x > t)) END AS bin, 
    CASE WHEN d <= 10 THEN x END AS number, CAST(NULL AS VARCHAR) AS category
  FROM {name}_n n JOIN edges USING (feature)
  UNION ALL
  SELECT {key}, {keep}, feature, NULL, NULL, v FROM {name}_c JOIN few USING (feature))""")
    ctes.append(f"""counted AS (
  SELECT feature, bin, number, category, sum(1 - {keep}) + 0.0001e0 AS good_count, sum({keep}) + 0.0001e0 AS bad_count
  FROM fit_rows_b WHERE bin IS NOT NULL OR number IS NOT NULL OR category IS NOT NULL
  GROUP BY feature, bin, number, category)""")
    ctes.append("""rated AS (
  SELECT *, good_count / sum(good_count) OVER (PARTITION BY feature) AS good_rate,
    bad_count / sum(bad_count) OVER (PARTITION BY feature) AS bad_rate FROM counted)""")
    ctes.append("""w AS (
  SELECT *, ln(good_rate / bad_rate) AS woe, (good_rate - bad_rate) * ln(good_rate / bad_rate) AS iv,
    coalesce(bin, row_number() OVER (PARTITION BY feature ORDER BY number, category) - 1) AS bin_id
  FROM rated)""")
    ctes.append("ivs AS (SELECT feature, sum(iv) AS iv FROM w GROUP BY feature)")
    ctes.append(f"""cells AS (
  SELECT {key}, b.{keep}, b.feature, coalesce(w.woe, 0e0) AS woe, w.bin_id
  FROM apply_rows_b b LEFT JOIN w ON b.feature = w.feature AND (b.bin = w.bin OR b.number = w.number
    OR b.category = w.category))""")
    return ctes


# Log-odds and probability of the closed-form scorecard.
SCORE_CTES = [
    f"chosen AS (SELECT feature, iv, count(*) OVER () AS k FROM ivs WHERE {SELECTED_RANGE})",
    """constant AS (SELECT ln(sum(bad_count) / sum(good_count)) AS intercept FROM w
  WHERE feature = (SELECT feature FROM chosen ORDER BY iv DESC, feature LIMIT 1))""",
    """scores AS (
  SELECT loan_id, y, 1e0 / (1e0 + exp(-(any_value(intercept) - sum(woe ORDER BY iv DESC)))) AS score
  FROM cells JOIN chosen USING (feature), constant GROUP BY loan_id, y)"""]


def scorecard_test() -> list[str]:
    return [*scorecard_rows(), *weights("train_rows", "test_rows"), *SCORE_CTES]


def scorecard_rows() -> list[str]:
    return [labelled(), *split(), "train_rows AS (SELECT * FROM flagged WHERE NOT is_test)",
            "test_rows AS (SELECT * FROM flagged WHERE is_test)"]


def metric_ctes(scores: str, prefix: str = "") -> list[str]:
    """AUC with ties half, KS and Brier of a (y, score) source."""
    return [
        f"{prefix}by_score AS (SELECT score, sum(1 - y) AS n0, sum(y) AS n1 FROM {scores} GROUP BY score)",
        f"""{prefix}steps AS (
  SELECT *, sum(n0) OVER (ORDER BY score) AS c0, sum(n1) OVER (ORDER BY score) AS c1,
    sum(n0) OVER () AS t0, sum(n1) OVER () AS t1 FROM {prefix}by_score)""",
        f"""{prefix}m AS (
  SELECT CAST(any_value(t0 + t1) AS BIGINT) AS n, CAST(any_value(t1) AS BIGINT) AS n_bad,
    sum(n1 * (c0 - n0 / 2e0)) / any_value(t0::DOUBLE * t1) AS auc,
    max(abs(c0 / t0::DOUBLE - c1 / t1::DOUBLE)) AS ks,
    (SELECT avg((score - y) * (score - y)) FROM {scores}) AS brier FROM {prefix}steps)"""]


def all_metrics(prefix: str = "") -> str:
    return (f"SELECT n, n_bad, {tidy('auc')} AS auc, {tidy('2 * auc - 1')} AS gini, "
            f"{tidy('ks')} AS ks, {tidy('brier')} AS brier FROM {prefix}m")


RULE = ("CASE WHEN coalesce(grade IN ('E', 'F', 'G'), false) OR coalesce(dti > 30, false) "
        "THEN 1e0 ELSE 0e0 END")
RULE_CTE = f"rule_scores AS (SELECT y, {RULE} AS score FROM flagged WHERE is_test)"
MAJORITY_CTE = """major_scores AS (
  SELECT y, (SELECT CASE WHEN sum(y) > sum(1 - y) THEN 1e0 ELSE 0e0 END FROM flagged WHERE NOT is_test)
    AS score FROM flagged WHERE is_test)"""


# The cleaned table that is profiled: all rows labelled, drops, every fill.
CLEAN_NUMBERS = ("n_items", "avg_disc", "sum_qty", "int_rate", "dti", "revol_util")
DROPPED = ("id", "member_id", "recoveries", "dti_joint", "pymnt_plan")


def clean_ctes() -> list[str]:
    kept = [c for c in LOAN_COLUMNS if c not in DROPPED]
    special = {"emp_length": "coalesce(s.emp_length, 'Unknown') AS emp_length",
               "emp_title": "coalesce(s.emp_title, 'Not Provided') AS emp_title",
               "mths_since_last_delinq": "coalesce(s.mths_since_last_delinq, 999e0) AS mths_since_last_delinq",
               "home_ownership": "coalesce(s.home_ownership, top.home_ownership) AS home_ownership",
               **{c: f"coalesce(CAST(s.{c} AS DOUBLE), med.{c}) AS {c}" for c in CLEAN_NUMBERS}}
    listed = ", ".join(special.get(c, f"s.{c}") for c in kept)
    return [labelled("all_rows"), *fills(CLEAN_NUMBERS, "lab", ["home_ownership"]),
            f"clean AS (SELECT {listed}, y, y AS default_status FROM lab s, med, top)"]


def correlations(names: Sequence[str], source: str = "clean") -> str:
    pairs = ", ".join(f"corr({a}, {b}) AS \"{a}|{b}\", regr_count({a}, {b}) AS \"{a}#{b}\"" for a in names for b in names)
    unions = " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, \"{a}|{b}\" AS corr, \"{a}#{b}\" AS n FROM wide"
                                for a in names for b in names)
    return f"wide AS (SELECT {pairs} FROM {source}), corrs AS ({unions})"


def logistic(matrix: str, features: Sequence[str], inverse_penalty: str, sweeps: int = 150) -> list[str]:
    """L2 logistic regression of ``matrix`` by Newton steps on one coefficient at a time.

    The objective is convex, so any descent ends at the same coefficients. The intercept is not
    penalised. ``beta`` is the last step's row ``b0, b1, ...``.
    """
    size = len(features) + 1
    x = ["1e0"] + [f"x{i}" for i in range(1, size)]
    z = " + ".join(f"b{i} * {v}" for i, v in enumerate(x))
    pick = "CASE step % " + str(size) + " " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(x)) + " END"
    betas = ", ".join(f"b{i}" for i in range(size))
    moved = ", ".join(
        f"CASE WHEN step % {size} = {i} THEN b{i} - (g + {0 if i == 0 else f'b{i} / {inverse_penalty}'})"
        f" / (h + {0 if i == 0 else f'1e0 / {inverse_penalty}'}) ELSE b{i} END" for i in range(size))
    return [
        "pts AS MATERIALIZED (SELECT " + ", ".join(f"{c} AS x{i}" for i, c in enumerate(features, 1))
        + f", y, count(*) AS n FROM {matrix} GROUP BY ALL)",
        f"""steps_taken AS (
  SELECT 0 AS step, {", ".join(f"0e0 AS b{i}" for i in range(size))}
  UNION ALL
  SELECT step + 1, {moved} FROM (
    SELECT step, {betas}, sum(n * (p - y) * x) AS g, sum(n * p * (1 - p) * x * x) AS h FROM (
      SELECT step, {betas}, n, y, {pick} AS x, 1e0 / (1e0 + exp(-({z}))) AS p FROM steps_taken, pts
      WHERE step < {sweeps * size}) GROUP BY step, {betas}))""",
        f"beta AS (SELECT {betas} FROM steps_taken WHERE step = {sweeps * size})"]


def recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql.removeprefix("WITH")


BASELINE_FILLED = [
    "train_rows AS (SELECT * FROM flagged WHERE NOT is_test)", *fills(NUMBERS, "train_rows"),
    f"filled AS (SELECT s.loan_id, s.y, is_test, {cols(NUMBERS, 'coalesce(CAST(s.{c} AS DOUBLE), med.{c}) AS {c}')} FROM flagged s, med)",
    f"scale AS (SELECT {cols(NUMBERS, 'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}')} FROM filled WHERE NOT is_test)",
    f"scaled AS (SELECT loan_id, y, is_test, {cols(NUMBERS, '({c} - m_{c}) / s_{c} AS {c}')} FROM filled, scale)"]


def baseline_regression() -> str:
    z = " + ".join(["b0"] + [f"b{i} * {c}" for i, c in enumerate(NUMBERS, 1)])
    ctes = with_loans(
        labelled(), *split(), *BASELINE_FILLED, "fit_matrix AS (SELECT * FROM scaled WHERE NOT is_test)",
        *logistic("fit_matrix", NUMBERS, "1e0"),
        f"scores AS (SELECT y, 1e0 / (1e0 + exp(-({z}))) AS score FROM scaled, beta WHERE is_test)",
        *metric_ctes("scores"))
    return recursive(ctes) + f"""SELECT 'Logistic Regression' AS model, 'ROC-AUC' AS metric_name, {tidy('round_even(auc, 6)', 5)} AS value,
  {tidy('round_even(ks, 6)', 5)} AS KS, {tidy('round_even(brier, 6)', 5)} AS Brier, {tidy('b0', 5)} AS intercept,
  {", ".join(f"{tidy(f'b{i}', 5)} AS beta_{c}" for i, c in enumerate(NUMBERS, 1))} FROM m, beta"""


def regression_ctes(rows: str) -> list[str]:
    """Regression on the weights of ``cells``; ``rows`` selects the training keys.

    Every feature takes part; one outside the selected range has its weight set to 0, which the
    penalty turns into a coefficient of 0.
    """
    wide = ", ".join(
        f"coalesce(max(CASE WHEN feature = '{c}' AND k IS NOT NULL THEN woe END), 0e0) AS {c}" for c in FEATURES)
    return [SCORE_CTES[0],
            f"wide_cells AS (SELECT loan_id, y, {wide} FROM cells LEFT JOIN chosen USING (feature) GROUP BY loan_id, y)",
            f"fit_matrix AS (SELECT * FROM wide_cells WHERE loan_id IN ({rows}))",
            *logistic("fit_matrix", FEATURES, "0.1e0"),
            "named AS (" + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, b{i} AS coefficient FROM beta" for i, c in enumerate(FEATURES, 1)) + ")"]


def woe_regression() -> str:
    return recursive(with_loans(*scorecard_rows(), *weights("train_rows", "train_rows"),
                                *regression_ctes("SELECT loan_id FROM train_rows")))


def new_loan_scores(new_columns: str = "*") -> list[str]:
    """Weights from all old loans, regression on their training part, scores of the new loans."""
    columns = "loan_id, y, " + ", ".join(FEATURES)
    z = " + ".join(["b0"] + [f"b{i} * {c}" for i, c in enumerate(FEATURES, 1)])
    return [labelled("all_rows", "old_rows", f"(SELECT * FROM loans WHERE issue_d < TIMESTAMP '{NEW_LOANS_FROM}')"),
            labelled("all_rows", "new_rows", f"(SELECT {new_columns} FROM loans WHERE issue_d >= TIMESTAMP '{NEW_LOANS_FROM}')"),
            *split(source="old_rows"), f"both_rows AS (SELECT {columns} FROM old_rows UNION ALL SELECT {columns} FROM new_rows)",
            *weights("old_rows", "both_rows"), *regression_ctes("SELECT loan_id FROM flagged WHERE NOT is_test"),
            f"""scores AS (SELECT loan_id, y, 1e0 / (1e0 + exp(-({z}))) AS score FROM wide_cells, beta
  WHERE loan_id IN (SELECT loan_id FROM new_rows))"""]


def documents_iv() -> str:
    ctes = ["docs AS (SELECT doc_id, lang, source, n_chars, quality AS y FROM documents JOIN labels USING (doc_id))",
            *weights("docs", "docs", ["n_chars"], ["lang", "source"], key="doc_id", fill=False)]
    return "WITH " + ",\n".join(ctes) + "\n"


POWER = """CASE WHEN iv < 0.02e0 THEN 'Not useful' WHEN iv < 0.1e0 THEN 'Weak' WHEN iv < 0.3e0 THEN 'Medium'
  WHEN iv < 0.5e0 THEN 'Strong' ELSE 'Suspicious' END AS predictive_power"""

def card(mode: str = "reference") -> str:
    """Points of every bin of the regression's features."""
    offset = OFFSET if mode == "reference" else f"{OFFSET} / k"
    own, base = f"round_even(-{FACTOR} * woe * coefficient, 0)", f"round_even({offset} - {FACTOR} * (b0 / k), 0)"
    return (f"card AS (SELECT feature, bin_id, category, {own} + {base} AS points, {own} AS own, {base} AS base, k "
            "FROM w JOIN chosen USING (feature) JOIN named USING (feature), beta)")


def regression_rows(share: str = "0.2e0") -> list[str]:
    """Weights and regression from the training rows, and the weights of every row in ``cells``."""
    rows = [labelled(), *split(share), "train_rows AS (SELECT * FROM flagged WHERE NOT is_test)",
            "test_rows AS (SELECT * FROM flagged WHERE is_test)"]
    return [*rows, *weights("train_rows", "flagged"), *regression_ctes("SELECT loan_id FROM train_rows")]


def regression_test() -> list[str]:
    z = " + ".join(["b0"] + [f"b{i} * {c}" for i, c in enumerate(FEATURES, 1)])
    return [*regression_rows(), f"""scores AS (SELECT loan_id, y, 1e0 / (1e0 + exp(-({z}))) AS score FROM wide_cells, beta
  WHERE loan_id IN (SELECT loan_id FROM test_rows))"""]


def baseline_found() -> str:
    """Metrics of the logistic baseline."""
    z = " + ".join(["b0"] + [f"b{i} * {c}" for i, c in enumerate(NUMBERS, 1)])
    return recursive(with_loans(
        labelled(), *split(), *BASELINE_FILLED, "fit_matrix AS (SELECT * FROM scaled WHERE NOT is_test)",
        *logistic("fit_matrix", NUMBERS, "1e0"),
        f"scores AS (SELECT y, 1e0 / (1e0 + exp(-({z}))) AS score FROM scaled, beta WHERE is_test)",
        *metric_ctes("scores"))) + "SELECT * FROM m"


def baseline_scores() -> str:
    """Held-out rows scored by the logistic baseline."""
    z = " + ".join(["b0"] + [f"b{i} * {c}" for i, c in enumerate(NUMBERS, 1)])
    return recursive(with_loans(
        labelled(), *split(), *BASELINE_FILLED, "fit_matrix AS (SELECT * FROM scaled WHERE NOT is_test)",
        *logistic("fit_matrix", NUMBERS, "1e0"))) + f"SELECT loan_id, y, 1e0 / (1e0 + exp(-({z}))) AS score FROM scaled, beta WHERE is_test"


def segment_metrics() -> str:
    """Metrics of four models over all held-out rows, each grade and each month."""
    card = recursive(with_loans(*regression_test())) + "SELECT loan_id, y, score FROM scores"
    plain = with_loans(labelled(), *split()) + f"""SELECT loan_id, y, grade, strftime(issue_d, '%Y-%m') AS month, {RULE} AS rule,
  (SELECT CASE WHEN sum(y) > sum(1 - y) THEN 1e0 ELSE 0e0 END FROM flagged WHERE NOT is_test) AS majority FROM flagged WHERE is_test"""
    keys = "model, segment, value"
    return f"""WITH plain AS ({plain}),
scored AS (SELECT 'Logistic Regression' AS model, loan_id, y, score FROM ({baseline_scores()})
  UNION ALL SELECT 'WoE scorecard', loan_id, y, score FROM ({card})
  UNION ALL SELECT 'Policy rule', loan_id, y, rule FROM plain UNION ALL SELECT 'Majority class', loan_id, y, majority FROM plain),
long AS (
  SELECT model, 'all' AS segment, CAST(NULL AS VARCHAR) AS value, y, score FROM scored
  UNION ALL SELECT model, 'grade', grade, s.y, score FROM scored s JOIN plain USING (loan_id)
  UNION ALL SELECT model, 'month', month, s.y, score FROM scored s JOIN plain USING (loan_id)),
by_score AS (SELECT {keys}, score, sum(1 - y) AS n0, sum(y) AS n1 FROM long GROUP BY ALL),
steps AS (SELECT *, sum(n0) OVER o AS c0, sum(n1) OVER o AS c1, sum(n0) OVER k AS t0, sum(n1) OVER k AS t1 FROM by_score
  WINDOW k AS (PARTITION BY {keys}), o AS (PARTITION BY {keys} ORDER BY score)),
m AS (SELECT {keys}, CAST(any_value(t0 + t1) AS BIGINT) AS n, CAST(any_value(t1) AS BIGINT) AS n_bad,
  CASE WHEN any_value(t0 * t1) > 0 THEN sum(n1 * (c0 - n0 / 2e0)) / any_value(t0::DOUBLE * t1) END AS auc,
  CASE WHEN any_value(t0 * t1) > 0 THEN max(abs(c0 / t0::DOUBLE - c1 / t1::DOUBLE)) END AS ks,
  sum(n0 * score * score + n1 * (1 - score) * (1 - score)) / any_value(t0 + t1) AS brier FROM steps GROUP BY ALL)
SELECT {keys}, n, n_bad, {tidy('auc', 5)} AS auc, {tidy('2 * auc - 1', 5)} AS gini, {tidy('ks', 5)} AS ks, {tidy('brier', 5)} AS brier FROM m"""


def grade_roc() -> str:
    """ROC points of the scorecard by grade."""
    card = recursive(with_loans(*regression_test())) + "SELECT loan_id, y, score FROM scores"
    return f"""WITH by_score AS (SELECT grade, score, sum(1 - y) AS n0, sum(y) AS n1 FROM ({card}) JOIN
  ({with_loans()} SELECT loan_id, grade FROM loans) USING (loan_id) GROUP BY ALL),
steps AS (SELECT *, sum(n0) OVER d AS c0, sum(n1) OVER d AS c1, sum(n0) OVER k AS t0, sum(n1) OVER k AS t1 FROM by_score
  WINDOW k AS (PARTITION BY grade), d AS (PARTITION BY grade ORDER BY score DESC))
SELECT DISTINCT grade, 'infinity'::DOUBLE AS threshold, 0e0 AS fpr, 0e0 AS tpr FROM steps UNION ALL
SELECT grade, round(score, 4), round(c0 / nullif(t0, 0)::DOUBLE, 6), round(c1 / nullif(t1, 0)::DOUBLE, 6) FROM steps"""


def stump_ctes() -> list[str]:
    """The best single split of the training rows without the held-out slice, and the test rows' scores.

    The first tree of a boosted ensemble fits the outcome as -1 and 1; log-odds are twice its leaves.
    """
    coded = ("coded AS (SELECT *, ascii(grade) - 64 AS grade_no, CAST(regexp_extract(term, '(\\d+)', 1) AS INT) AS months FROM flagged)")
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, 2 * y - 1 AS s FROM fit_rows" for c in STUMP)
    return [
        labelled(), *split(), coded, "known AS (SELECT * FROM coded WHERE NOT is_test)", *fills(STUMP, "known"),
        f"matrix AS (SELECT s.loan_id, s.y, is_test, {cols(STUMP, 'coalesce(CAST(s.{c} AS DOUBLE), med.{c}) AS {c}')} FROM coded s, med)",
        "fit_rows AS (SELECT * FROM matrix WHERE NOT is_test AND substr(md5(concat(CAST(loan_id AS string), '|validation|42')), 1, 8) >= '19999999')",
        f"by_value AS (SELECT feature, x, count(*) AS n, sum(s) AS s FROM ({long}) GROUP BY feature, x)",
        """cuts AS (SELECT feature, (x + lead(x) OVER v) / 2 AS cut, sum(n) OVER v AS ln, sum(s) OVER v AS ls,
  sum(n) OVER (PARTITION BY feature) AS tn, sum(s) OVER (PARTITION BY feature) AS ts FROM by_value WINDOW v AS (PARTITION BY feature ORDER BY x))""",
        """best AS (SELECT *, 2e0 * ls / ln AS low, 2e0 * (ts - ls) / (tn - ln) AS high, 2e0 * ts / tn AS expected FROM cuts
  WHERE cut IS NOT NULL AND ln >= 20 AND tn - ln >= 20
  ORDER BY ls::DOUBLE * ls / ln + (ts - ls)::DOUBLE * (ts - ls) / (tn - ln) DESC LIMIT 1)""",
        "placed AS (SELECT loan_id, y, CASE WHEN CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in STUMP)
        + " END <= cut THEN low ELSE high END AS odds, feature, expected FROM matrix, best WHERE is_test)",
        "scores AS (SELECT loan_id, y, 1e0 / (1e0 + exp(-odds)) AS score FROM placed)"]


def stump_ranking() -> str:
    listed = " UNION ALL ".join(f"SELECT '{c}' AS name" for c in STUMP)
    return with_loans(*stump_ctes()) + f"""SELECT name AS feature,
  round(coalesce(any_value(moved), 0e0), 6) AS importance, CASE WHEN any_value(moved) IS NULL THEN 0e0 ELSE 100e0 END AS importance_score
FROM ({listed}) l LEFT JOIN (SELECT feature, avg(abs(odds - expected)) AS moved FROM placed GROUP BY feature) p ON name = p.feature GROUP BY name"""


def stump_comparison() -> str:
    """The manifest of the logistic baseline and the stump on the same columns."""
    z = " + ".join(["b0"] + [f"b{i} * {c}" for i, c in enumerate(STUMP, 1)])
    baseline = recursive(with_loans(
        *stump_ctes()[:-6], f"scale AS (SELECT {cols(STUMP, 'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}')} FROM matrix WHERE NOT is_test)",
        f"scaled AS (SELECT loan_id, y, is_test, {cols(STUMP, '({c} - m_{c}) / s_{c} AS {c}')} FROM matrix, scale)",
        "fit_matrix AS (SELECT * FROM scaled WHERE NOT is_test)", *logistic("fit_matrix", STUMP, "1e0"),
        f"scores AS (SELECT y, 1e0 / (1e0 + exp(-({z}))) AS score FROM scaled, beta WHERE is_test)", *metric_ctes("scores"))) + "SELECT * FROM m"
    stump = with_loans(*stump_ctes(), *metric_ctes("scores")) + "SELECT m.*, feature, (SELECT count(*) FROM lab) AS kept FROM m, best"
    passed = "s.auc >= 0.72e0 AND s.auc - b.auc >= 0.04e0"
    return f"""SELECT 'raw' AS data_mode_used, kept AS data_rows_after_filter, CAST({len(STUMP)} AS BIGINT) AS features_used, s.n AS test_set_size,
  round(round_even(b.auc, 6), 5) AS baseline_roc_auc, round(round_even(s.auc, 6), 5) AS primary_roc_auc, {passed} AS primary_passed,
  round(round_even(2 * s.auc - 1, 6), 5) AS gini_coefficient, feature AS top_feature, round(round_even(b.ks, 6), 5) AS baseline_ks,
  round(round_even(b.brier, 6), 5) AS baseline_brier, round(round_even(s.ks, 6), 5) AS primary_ks, round(round_even(s.brier, 6), 5) AS primary_brier
FROM ({baseline}) b, ({stump}) s"""


def period_back_test() -> str:
    """Metrics of the new loans by periods of 30 days of their outcomes."""
    scored = recursive(with_loans(*new_loan_scores())) + "SELECT loan_id, y, score FROM scores"
    return f"""WITH known AS ({with_loans()} SELECT loan_id, CAST(issue_d AS TIMESTAMP) + to_days(CAST(loan_id % 120 AS INTEGER)) AS known_at FROM loans),
placed AS (SELECT time_bucket(INTERVAL 30 DAY, known_at, TIMESTAMP '1970-01-01') AS period, y, round(score, 6) AS score FROM ({scored}) JOIN known USING (loan_id)),
by_score AS (SELECT period, score, sum(1 - y) AS n0, sum(y) AS n1 FROM placed GROUP BY ALL),
steps AS (SELECT *, sum(n0) OVER o AS c0, sum(n1) OVER o AS c1, sum(n0) OVER k AS t0, sum(n1) OVER k AS t1 FROM by_score
  WINDOW k AS (PARTITION BY period), o AS (PARTITION BY period ORDER BY score))
SELECT strftime(period, '%Y-%m-%d') AS period, CAST(any_value(t0 + t1) AS BIGINT) AS n, CAST(any_value(t1) AS BIGINT) AS n_bad,
  CASE WHEN any_value(t0 * t1) > 0 THEN round(sum(n1 * (c0 - n0 / 2e0)) / any_value(t0::DOUBLE * t1), 4) END AS auc,
  CASE WHEN any_value(t0 * t1) > 0 THEN round(max(abs(c0 / t0::DOUBLE - c1 / t1::DOUBLE)), 4) END AS ks,
  round(sum(n0 * score * score + n1 * (1 - score) * (1 - score)) / any_value(t0 + t1), 4) AS brier FROM steps GROUP BY period"""


def group_stats(group: str, spread: bool) -> str:
    std = ", round_even(stddev_samp(int_rate), 3) AS Interest_Rate_Std" if spread else ""
    return (f"SELECT {group}, count(y) AS Total_Loans, CAST(sum(y) AS BIGINT) AS Defaults, "
            f"round_even(avg(y), 3) AS Default_Rate, round_even(avg(int_rate), 3) AS Avg_Interest_Rate"
            f"{std}, round_even(avg(loan_amnt), 3) AS Avg_Loan_Amount FROM clean GROUP BY {group}")


def histograms() -> str:
    parts = []
    for c in PROFILED:
        for k in (0, 1):
            parts.append(f"SELECT '{c}' AS variable, {k} AS class, {c} AS x FROM clean WHERE y = {k} AND {c} IS NOT NULL")
    return ("long AS (" + " UNION ALL ".join(parts) + """),
ends AS (SELECT variable, class, CASE WHEN min(x) = max(x) THEN min(x) - 0.5e0 ELSE min(x) END AS a,
  CASE WHEN min(x) = max(x) THEN max(x) + 0.5e0 ELSE max(x) END AS z, count(*) AS total FROM long GROUP BY ALL),
slots AS (SELECT variable, class, b AS bin, a + b * ((z - a) / 50) AS bin_lo,
  CASE WHEN b = 49 THEN 'infinity'::DOUBLE ELSE a + (b + 1) * ((z - a) / 50) END AS bin_hi FROM ends, range(0, 50) AS r(b)),
tallied AS (SELECT l.variable, l.class, s.bin, count(*) AS n FROM long l JOIN slots s
  ON l.variable = s.variable AND l.class = s.class AND l.x >= s.bin_lo AND l.x < s.bin_hi GROUP BY ALL)
""")


def oracle_sql() -> dict[str, str]:
    lab = labelled()
    clean = with_loans(*clean_ctes())
    fitted = with_loans(lab, *weights("lab", "lab"))
    tested = recursive(with_loans(*regression_test(), *metric_ctes("scores")))
    closed = with_loans(*scorecard_test(), *metric_ctes("scores"))
    flagged = with_loans(lab, *split())
    both = recursive(with_loans(*regression_test(), *metric_ctes("scores"), RULE_CTE,
                                *metric_ctes("rule_scores", "r"), MAJORITY_CTE, *metric_ctes("major_scores", "j")))
    csv_numbers = ("loan_id", "loan_amnt", "annual_inc", *CLEAN_NUMBERS,
                   "mths_since_last_delinq", "funded_amnt", "installment", "total_pymnt",
                   "recoveries", "dti_joint")
    matrix_names = ("loan_amnt", "annual_inc", "n_items", "avg_disc", "sum_qty", "int_rate", "dti",
                    "mths_since_last_delinq", "revol_util", "funded_amnt", "installment")
    nullable = [c for c in LOAN_COLUMNS]
    record = ("SELECT '{name}' AS model, 'ROC-AUC' AS metric_name, round_even(auc, 6) AS value, "
              "round_even(ks, 6) AS KS, round_even(brier, 6) AS Brier FROM {p}m")
    wide_cells = ", ".join(f"max(CASE WHEN feature = '{c}' THEN woe END) AS {c}" for c in FEATURES)
    gate = (f"(SELECT b.auc AS baseline_auc, w.auc AS primary_auc, w.n, w.ks, w.brier "
            f"FROM ({baseline_found()}) b, ({tested}SELECT * FROM m) w)")
    passed = "primary_auc >= 0.72e0 AND primary_auc - baseline_auc >= 0.04e0"
    roc = """SELECT 'infinity'::DOUBLE AS threshold, 0e0 AS fpr, 0e0 AS tpr UNION ALL
SELECT round(score, 4), round(sum(n0) OVER d / t0::DOUBLE, 6), round(sum(n1) OVER d / t1::DOUBLE, 6) FROM steps
WINDOW d AS (ORDER BY score DESC)"""
    sql = {
        "load_loans": with_loans() + "SELECT 'fallback' AS data_mode, " + ", ".join(
            f"CAST({c} AS DOUBLE) AS {c}" if c in csv_numbers else
            f"strftime({c}, '%Y-%m-%d') AS {c}" if c == "issue_d" else c for c in LOAN_COLUMNS) + " FROM loans",
        "csv_types": with_loans() + """SELECT 'loan_id:bigint,unit:string,amount:double,amount.1:double,power:double' AS kinds, loan_id,
  CAST(n_items AS VARCHAR) || CASE WHEN n_items % 2 = 0 THEN 'D' ELSE 'F' END AS unit, loan_amnt AS amount,
  CAST(n_items AS DOUBLE) AS items, n_items * 100e0 AS power FROM loans""",
        "refused_rows": with_loans("""placed AS (SELECT *, row_number() OVER (PARTITION BY grade ORDER BY loan_id) + 1 AS line FROM loans)""")
            + """SELECT 'refused' AS fate, grade, line, concat(loan_id, ',', purpose) AS text FROM placed WHERE n_items = 3
UNION ALL SELECT 'kept', NULL, loan_id, purpose FROM placed WHERE n_items IS DISTINCT FROM 3""",
        "key_first_csv": with_loans() + "SELECT 'loan_status' AS first_column, loan_id, loan_amnt, grade, loan_status FROM loans",
        "json_record": with_loans(lab) + """SELECT count(*) AS total_rows, count(*) FILTER (y = 0) AS good_loans,
  count(*) FILTER (y = 1) AS bad_loans, round(avg(y), 6) AS bad_rate, CAST(NULL AS VARCHAR) AS note FROM lab""",
        "probe_columns": with_loans() + "SELECT loan_status, loan_amnt, dti, grade FROM loans ORDER BY loan_id LIMIT 5",
        "target_four_status": with_loans(lab) + "SELECT loan_id, loan_status, CAST(y AS BIGINT) AS defaultstatus FROM lab",
        "target_all_rows": with_loans(labelled("all_rows")) + "SELECT loan_id, loan_status, CAST(y AS BIGINT) AS default_status FROM lab",
        "target_summary": with_loans(lab) + f"""SELECT count(*) AS total_rows, CAST({len(LOAN_COLUMNS) + 1} AS BIGINT) AS total_columns,
  count(*) FILTER (y = 0) AS good_loans, count(*) FILTER (y = 1) AS bad_loans,
  round(avg(1 - y), 6) AS good_rate, round(avg(y), 6) AS bad_rate FROM lab""",
        "status_distribution": with_loans() + "SELECT loan_status, count(*) AS n FROM loans GROUP BY loan_status",
        "event_distribution": "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
        "missing_profile": with_loans() + "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count, "
            f"round(count(*) FILTER ({c} IS NULL) * 100e0 / count(*), 6) AS missing_pct FROM loans"
            for c in nullable) + ") WHERE missing_count > 0",
        "missing_profile_observed": with_loans(lab) + "SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count, "
            f"round(count(*) FILTER ({c} IS NULL) * 100e0 / count(*), 6) AS missing_pct FROM lab"
            for c in nullable) + ") WHERE missing_count > 0",
        "residual_nulls": clean + "SELECT CAST(" + cols(
            [c for c in LOAN_COLUMNS if c not in DROPPED], "count(*) FILTER ({c} IS NULL)", " + ")
            + " AS BIGINT) AS remaining_nulls, " + cols(
            [c for c in LOAN_COLUMNS if c not in DROPPED], "count(*) FILTER ({c} IS NULL)", " + ")
            + " = 0 AS complete FROM clean",
        "impute_constants": with_loans() + """SELECT loan_id, coalesce(emp_length, 'Unknown') AS emp_length,
  coalesce(emp_title, 'Not Provided') AS emp_title, coalesce(mths_since_last_delinq, 999e0) AS mths_since_last_delinq FROM loans""",
        "impute_median": with_loans(*fills(["n_items", "avg_disc", "sum_qty", "revol_util"], "loans"))
            + "SELECT s.loan_id, " + cols(["n_items", "avg_disc", "sum_qty", "revol_util"],
                                        "round(coalesce(CAST(s.{c} AS DOUBLE), med.{c}), 6) AS {c}") + " FROM loans s, med",
        "impute_mode": with_loans(*fills(["loan_amnt"], "loans", ["home_ownership", "emp_length", "emp_title"]))
            + "SELECT s.loan_id, " + cols(["home_ownership", "emp_length", "emp_title"],
                                        "coalesce(s.{c}, top.{c}) AS {c}") + " FROM loans s, top",
        "clean_loans": clean + "SELECT " + ", ".join(
            f"{tidy(c)} AS {c}" if c in (*CLEAN_NUMBERS, "loan_amnt", "annual_inc", "funded_amnt",
                                         "installment", "total_pymnt", "mths_since_last_delinq") else c
            for c in LOAN_COLUMNS if c not in DROPPED) + ", CAST(default_status AS BIGINT) AS default_status FROM clean",
        "feature_matrix": with_loans(lab, *fills(matrix_names, "lab")) + "SELECT s.loan_id, CAST(y AS BIGINT) AS default_status, "
            + ", ".join(f"{tidy(f'coalesce(CAST(s.{c} AS DOUBLE), med.{c})')} AS {c}" for c in matrix_names) + " FROM lab s, med",
        "default_rate_by_category": clean + "SELECT variable, value, total_count, default_count, round(default_rate, 6) AS default_rate FROM ("
            "SELECT *, row_number() OVER (PARTITION BY variable ORDER BY default_rate DESC, value) AS place FROM ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS variable, {c} AS value, count(y) AS total_count, CAST(sum(y) AS BIGINT) AS default_count, "
                f"avg(y) AS default_rate FROM clean WHERE {c} IS NOT NULL GROUP BY {c}"
                for c in ("grade", "term", "home_ownership", "purpose", "addr_state", "emp_length"))
            + ")) WHERE place <= 10",
        "grade_stats": clean + group_stats("grade", True),
        "purpose_stats": clean + group_stats("purpose", False),
        "grade_default_rates": with_loans(lab) + """SELECT grade, count(y) AS total_loans, CAST(sum(y) AS BIGINT) AS defaults,
  round(avg(y), 6) AS default_rate FROM lab GROUP BY grade""",
        "class_crosstab_pct": clean + """SELECT grade, count(*) FILTER (y = 0) AS good_count, count(*) FILTER (y = 1) AS bad_count,
  round(count(*) FILTER (y = 0)::DOUBLE / count(y) * 100, 6) AS good_pct,
  round(count(*) FILTER (y = 1)::DOUBLE / count(y) * 100, 6) AS bad_pct FROM clean GROUP BY grade""",
        "describe_by_class": clean + "SELECT variable, statistic, round(good, 4) AS good, round(bad, 4) AS bad, "
            + tidy("bad - good", 4) + " AS difference FROM (" + " UNION ALL ".join(
                f"SELECT '{c}' AS variable, '{s}' AS statistic, {f} FILTER (y = 0) AS good, {f} FILTER (y = 1) AS bad FROM clean"
                for c in PROFILED for s, f in (("mean", f"avg({c})"), ("median", f"quantile_cont({c}, 0.5)"),
                                               ("std", f"stddev_samp({c})"))) + ")",
        "corr_matrix": with_loans(*clean_ctes(), correlations(CORRELATED)) + f"SELECT var1, var2, {tidy('corr')} AS corr FROM corrs",
        "corr_all_numbers": with_loans(correlations(LOAN_NUMBERS, "loans")) + f"SELECT var1, var2, CAST(n AS BIGINT) AS n, {tidy('corr')} AS corr FROM corrs",
        "corr_with_target": with_loans(*clean_ctes(), correlations(CORRELATED)) + """SELECT var2 AS variable, round(abs(corr), 6) AS abs_corr
FROM corrs WHERE var1 = 'default_status' AND var2 <> 'default_status' ORDER BY abs(corr) DESC, var2 LIMIT 15""",
        "high_corr_pairs": with_loans(*clean_ctes(), correlations(CORRELATED)) + f"SELECT var1, var2, {tidy('corr')} AS corr FROM corrs "
            f"WHERE list_position({list(CORRELATED)!r}, var1) < list_position({list(CORRELATED)!r}, var2) AND abs(corr) > 0.8e0",
        "hist_by_class": with_loans(*clean_ctes(), histograms()) + f"""SELECT variable, CAST(class AS BIGINT) AS class, b AS bin,
  {tidy('a + (z - a) / 50 * b', 4)} AS lo, {tidy('a + (z - a) / 50 * (b + 1)', 4)} AS hi, coalesce(n, 0) AS n,
  round(coalesce(n, 0) / (total * ((z - a) / 50)), 8) AS density
FROM (SELECT * FROM ends, range(0, 50) AS r(b)) g LEFT JOIN tallied t
  ON t.variable = g.variable AND t.class = g.class AND t.bin = g.b"""
            .replace("SELECT variable,", "SELECT g.variable AS variable,").replace("CAST(class", "CAST(g.class"),
        "box_by_grade_class": clean + f"""SELECT f.grade, CAST(f.y AS BIGINT) AS class, f.n, {tidy('q[1]')} AS q1, {tidy('q[2]')} AS median, {tidy('q[3]')} AS q3,
  {tidy('min(int_rate) FILTER (inside)')} AS whisker_lo, {tidy('max(int_rate) FILTER (inside)')} AS whisker_hi,
  count(*) FILTER (NOT inside) AS outliers
FROM (SELECT grade, y, count(*) AS n, quantile_cont(int_rate, [0.25e0, 0.5e0, 0.75e0]) AS q FROM clean GROUP BY grade, y) f
JOIN (SELECT c.*, int_rate BETWEEN q[1] - 1.5e0 * (q[3] - q[1]) AND q[3] + 1.5e0 * (q[3] - q[1]) AS inside
      FROM clean c JOIN (SELECT grade, y, quantile_cont(int_rate, [0.25e0, 0.5e0, 0.75e0]) AS q FROM clean GROUP BY grade, y) k
        ON c.grade = k.grade AND c.y = k.y) x
  ON f.grade = x.grade AND f.y = x.y GROUP BY f.grade, f.y, f.n, q""",
        "quantile_edges": with_loans(lab) + "SELECT feature, CAST(generate_subscripts(e, 1) - 1 AS BIGINT) AS edge_no, round(unnest(e), 6) AS edge FROM ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), "
                "[0e0, 0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0, 1e0]))) AS e FROM lab" for c in NUMBERS) + ")",
        "profile_merged": with_loans() + "SELECT feature, n, missing, round(low, 6) AS low, round(high, 6) AS high, few, " + ", ".join(
            f"round(q[{k}], 6) AS d{k}" for k in range(1, 10)) + " FROM (" + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, count(*) AS n, count(*) - count({c}) AS missing, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, "
                f"count(DISTINCT {c}) <= 10 AS few, quantile_cont(CAST({c} AS DOUBLE), "
                "[0.1e0, 0.2e0, 0.3e0, 0.4e0, 0.5e0, 0.6e0, 0.7e0, 0.8e0, 0.9e0]) AS q FROM loans" for c in LOAN_NUMBERS) + ")",
        "equal_width_edges": with_loans(lab) + "SELECT feature, k AS edge_no, round(CASE WHEN k = 10 THEN z ELSE a + k * ((z - a) / 10) END, 6) AS edge FROM ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS a, CAST(max({c}) AS DOUBLE) AS z FROM lab"
                for c in NUMBERS) + "), range(0, 11) AS r(k)",
        "woe_bins": fitted + f"""SELECT feature, bin_id, category, {tidy('lo')} AS lo, {tidy('hi')} AS hi, round(good_count, 6) AS good_count, round(bad_count, 6) AS bad_count,
  round(good_rate, 6) AS good_rate, round(bad_rate, 6) AS bad_rate, {tidy('woe')} AS woe, {tidy('iv')} AS iv
FROM (SELECT w.*, CASE WHEN number IS NOT NULL THEN number WHEN bin = 0 THEN '-infinity'::DOUBLE ELSE e[bin + 1] END AS lo,
  CASE WHEN number IS NOT NULL THEN number WHEN bin = len(e) - 2 THEN 'infinity'::DOUBLE ELSE e[bin + 2] END AS hi
  FROM w LEFT JOIN edges USING (feature))""",
        "iv_all_variables": with_loans(lab, """lab2 AS (SELECT * REPLACE (coalesce(mths_since_last_delinq, 999e0) AS mths_since_last_delinq,
  coalesce(emp_length, 'Unknown') AS emp_length), emp_title AS employer FROM lab)""",
            *weights("lab2", "lab2", ALL_NUMBERS, ALL_TEXTS)) + f"SELECT feature, round(iv, 6) AS iv, {POWER} FROM ivs",
        "iv_summary": fitted + f"SELECT feature, round(iv, 6) AS iv, {POWER} FROM ivs",
        "iv_selection": fitted + f"SELECT feature, round(iv, 6) AS iv, {POWER} FROM ivs WHERE {SELECTED_RANGE}",
        "woe_transform": fitted + f"SELECT loan_id, CAST(y AS BIGINT) AS default_status, "
            + ", ".join(f"{tidy(c)} AS {c}_woe" for c in FEATURES)
            + f" FROM (SELECT loan_id, y, {wide_cells} FROM cells GROUP BY loan_id, y)",
        "document_iv": documents_iv() + f"SELECT feature, round(iv, 6) AS iv, {POWER} FROM ivs",
        "stratified_split": flagged + "SELECT loan_id, CAST(y AS BIGINT) AS default_status, is_test FROM flagged",
        "standardize": with_loans(lab, *split(), *BASELINE_FILLED)
            + f"SELECT loan_id, is_test, " + ", ".join(f"{tidy(c, 5)} AS {c}" for c in NUMBERS) + " FROM scaled",
        "metric_auc": tested + f"SELECT n, n_bad, {tidy('auc')} AS auc, {tidy('2 * auc - 1')} AS gini FROM m",
        "metric_ks": tested + f"SELECT n, n_bad, {tidy('ks')} AS ks FROM m",
        "stratified_split_rows": with_loans(lab, f"content AS (SELECT *, md5(concat_ws(chr(31), CAST(y AS string), "
            + ", ".join(ROW_COLUMNS) + ")) AS c FROM lab)", *split(source="content")[:3], """flagged AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.y ORDER BY md5(concat(c, '|split|42'))) <= n_test AS is_test
  FROM content l JOIN class_test t ON l.y = t.y)""") + f"""SELECT {", ".join(ROW_COLUMNS)}, count(*) AS n, count(*) FILTER (is_test) AS n_test
FROM flagged GROUP BY ALL""",
        "sampled_rows": with_loans() + f"""SELECT loan_id, grade FROM loans
ORDER BY md5(concat(CAST(loan_id AS string), '|sample|42')), loan_id LIMIT {SAMPLE}""",
        "metrics_in_buckets": tested + all_metrics(),
        "metrics_by_segment": segment_metrics(),
        "roc_by_grade": grade_roc(),
        "closed_form_metrics": closed + all_metrics(),
        "model_table": f"""SELECT 'Baseline LR' AS model, {tidy('baseline_auc')} AS roc_auc FROM {gate}
UNION ALL SELECT 'WoE scorecard', {tidy('primary_auc')} FROM {gate}""",
        "primary_record": f"""SELECT 'WoE scorecard' AS model, 'ROC-AUC' AS metric_name, round_even(primary_auc, 6) AS value, {passed} AS passed,
  0.72e0 AS threshold, round_even(primary_auc - baseline_auc, 6) AS lift_over_baseline, 0.04e0 AS lift_threshold,
  round_even(baseline_auc, 6) AS baseline_logreg_auc, round_even(ks, 6) AS KS, round_even(brier, 6) AS Brier FROM {gate}""",
        "gbt_stump": with_loans(*stump_ctes(), *metric_ctes("scores")) + f"""SELECT feature, {tidy('cut')} AS threshold, {tidy('low')} AS low_log_odds,
  {tidy('high')} AS high_log_odds, {tidy('expected')} AS expected_log_odds, n, n_bad, {tidy('auc')} AS auc, {tidy('ks')} AS ks,
  {tidy('brier')} AS brier FROM best, m""",
        "attribution_ranking": stump_ranking(),
        "attribution_top": f"SELECT * FROM ({stump_ranking()}) ORDER BY importance DESC, feature LIMIT 1",
        "attribution_additivity": flagged + "SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM flagged WHERE is_test",
        "metric_brier": tested + f"SELECT n, n_bad, {tidy('brier')} AS brier FROM m",
        "roc_curve": tested + roc,
        "roc_curve_plotted": tested + """SELECT 'infinity'::DOUBLE AS threshold, 0e0 AS fpr, 0e0 AS tpr UNION ALL
SELECT round(score, 4), round(d0 / t0::DOUBLE, 6), round(d1 / t1::DOUBLE, 6) FROM (
  SELECT *, sum(n0) OVER d AS d0, sum(n1) OVER d AS d1, lead(n0) OVER d AS next0, lead(n1) OVER d AS next1,
    row_number() OVER d AS place FROM steps WINDOW d AS (ORDER BY score DESC))
WHERE place = 1 OR next0 IS NULL OR next0 <> n0 OR next1 <> n1""",
        "pass_gate": f"""SELECT {tidy('baseline_auc')} AS baseline_auc, {tidy('primary_auc')} AS primary_auc,
  {tidy('primary_auc - baseline_auc')} AS lift, 0.72e0 AS threshold, 0.04e0 AS lift_threshold, {passed} AS passed FROM {gate}""",
        "metrics_report": both + " UNION ALL ".join(
            record.format(name=n, p=p) for n, p in (("Policy rule", "r"), ("Majority class", "j"), ("WoE scorecard", ""))),
        "rules_baseline": with_loans(lab, *split(), RULE_CTE, *metric_ctes("rule_scores")) + all_metrics(),
        "majority_baseline": with_loans(lab, *split(), MAJORITY_CTE, *metric_ctes("major_scores")) + all_metrics(),
        "scorecard_points_additive": recursive(with_loans(*regression_rows(), card("additive"))) + "SELECT feature, bin_id, points FROM card",
        "scorecard_categories": recursive(with_loans(*regression_rows(), card()))
            + "SELECT feature, category, points FROM card WHERE category IS NOT NULL",
        "scorecard_own_split": recursive(with_loans(*regression_rows("0.3e0"), card())) + "SELECT feature, bin_id, points FROM card",
        "score_points": recursive(with_loans(*regression_rows(), card("additive"))) + """
SELECT loan_id, any_value(base) * any_value(k) + sum(own) AS score FROM cells JOIN card USING (feature, bin_id)
WHERE loan_id IN (SELECT loan_id FROM test_rows) GROUP BY loan_id""",
        "scorecard_comparison": recursive(with_loans(
            *regression_rows(), card(),
            "means AS (SELECT feature, avg(woe) AS mean FROM cells WHERE loan_id IN (SELECT loan_id FROM train_rows) GROUP BY feature)",
            """pushes AS (SELECT feature, avg(abs(coefficient * (woe - mean))) AS importance FROM cells JOIN means USING (feature)
  JOIN chosen USING (feature) JOIN named USING (feature) WHERE loan_id IN (SELECT loan_id FROM test_rows) GROUP BY feature)"""))
            + f"""SELECT feature, min(points) AS min_points, max(points) AS max_points, max(points) - min(points) AS points_range,
  round(any_value(importance), 5) AS importance, round(any_value(importance) / any_value(top) * 100, 3) AS importance_score
FROM card JOIN pushes USING (feature), (SELECT max(importance) AS top FROM pushes) GROUP BY feature""",
        "score_new_gaps": recursive(with_loans(*new_loan_scores(
            "* REPLACE (CASE WHEN n_items = 3 THEN NULL ELSE n_items END AS n_items, CAST(NULL AS DOUBLE) AS avg_disc)")))
            + """SELECT id, member_id, round(loan_amnt, 6) AS loan_amnt, term, round(int_rate, 6) AS int_rate, grade,
  home_ownership, round(annual_inc, 6) AS annual_inc, round(score, 4) AS predicted_default_probability
FROM loans JOIN scores USING (loan_id)""",
        "score_new": recursive(with_loans(*new_loan_scores())) + """SELECT id, member_id, round(loan_amnt, 6) AS loan_amnt, term, round(int_rate, 6) AS int_rate, grade,
  home_ownership, round(annual_inc, 6) AS annual_inc, round(score, 4) AS predicted_default_probability
FROM loans JOIN scores USING (loan_id)""",
        "score_new_metrics": recursive(with_loans(*new_loan_scores(), *metric_ctes("scores")))
            + f"SELECT n, n_bad, {tidy('auc', 5)} AS auc, {tidy('2 * auc - 1', 5)} AS gini FROM m",
        "artifacts": recursive(with_loans(*regression_test())) + "SELECT loan_id, round(score, 4) AS predicted_default_probability FROM scores",
        "run_manifest": with_loans(lab) + f"""SELECT 'raw' AS data_mode_used, (SELECT count(*) FROM lab) AS data_rows_after_filter,
  CAST({len(FEATURES)} AS BIGINT) AS features_used, n AS test_set_size, round(round_even(baseline_auc, 6), 6) AS baseline_roc_auc,
  round(round_even(primary_auc, 6), 6) AS primary_roc_auc, {passed} AS primary_passed,
  round(round_even(2 * primary_auc - 1, 6), 6) AS gini_coefficient,
  printf('%s: WoE scorecard AUC = %.4f, LR baseline AUC = %.4f, lift = %.4f (required >= 0.04), AUC threshold passed = %s, lift threshold passed = %s',
    CASE WHEN {passed} THEN 'SUPPORTED' ELSE 'NOT SUPPORTED' END, primary_auc, baseline_auc, primary_auc - baseline_auc,
    CASE WHEN primary_auc >= 0.72e0 THEN 'True' ELSE 'False' END,
    CASE WHEN primary_auc - baseline_auc >= 0.04e0 THEN 'True' ELSE 'False' END) AS hypothesis_result FROM {gate}""",
    }
    sql["lr_baseline"] = baseline_regression()
    sql["lr_woe"] = woe_regression() + f"""SELECT feature, {tidy('coefficient', 5)} AS coefficient, coefficient > 0 AS unexpected_sign
FROM named JOIN chosen USING (feature)
UNION ALL SELECT '(intercept)', {tidy('b0', 5)}, false FROM beta"""
    sql["scorecard_points"] = recursive(with_loans(*regression_rows(), card())) + "SELECT feature, bin_id, points FROM card"
    sql["comparison_run"] = stump_comparison()
    sql["stream_back_test"] = period_back_test()
    sql["target_summary_observed"] = sql["target_summary"]
    sql["clean_from_profile"] = sql["clean_loans"]
    sql["quantile_edges_bracketed"] = sql["quantile_edges"]
    return sql
