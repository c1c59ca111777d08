"""Settings of a scorecard run, and the values that are fixed by definition."""

from __future__ import annotations

from dataclasses import dataclass, field

# Loan outcomes counted as bad, and the outcomes kept, per target policy.
FOUR_STATUS_BAD = ("Charged Off", "Default", "Late (31-120 days)")
FOUR_STATUS_KEPT = ("Charged Off", "Default", "Late (31-120 days)", "Fully Paid")
ALL_ROWS_BAD = ("Charged Off", "Default")

# Columns a usable loan file must have.
REQUIRED_COLUMNS = ("loan_status", "loan_amnt", "dti", "grade")

# Columns that are more than 90% empty.
SPARSE_COLUMNS = (
    "dti_joint", "annual_inc_joint", "verification_status_joint",
    "il_util", "mths_since_rcnt_il", "inq_fi", "open_rv_24m", "open_acc_6m",
    "all_util", "inq_last_12m", "total_cu_tl", "open_il_12m", "max_bal_bc",
    "open_il_6m", "open_il_24m", "open_rv_12m", "total_bal_il",
)

# Identifiers, free text, near-constant columns and loan outcomes.
IDENTIFIER_COLUMNS = ("id", "member_id")
NON_PREDICTIVE_COLUMNS = (
    "id", "member_id", "url", "desc", "pymnt_plan", "policy_code", "application_type",
    "zip_code", "title", "total_rec_prncp", "total_rec_int", "total_rec_late_fee",
    "recoveries", "collection_recovery_fee", "last_pymnt_amnt",
)

# Columns left out before binning.
COLLINEAR_COLUMNS = ("funded_amnt", "funded_amnt_inv", "out_prncp_inv", "total_pymnt_inv")
POST_OUTCOME_COLUMNS = ("last_pymnt_d", "out_prncp", "issue_d", "next_pymnt_d")
PROBLEMATIC_COLUMNS = ("emp_title", "loan_status")

# Columns never used as raw model features, because they are known only afterwards.
LEAKAGE_COLUMNS = (
    "loan_status", "total_rec_prncp", "total_rec_int", "total_rec_late_fee", "recoveries",
    "collection_recovery_fee", "last_pymnt_amnt", "last_pymnt_d", "next_pymnt_d",
    "total_pymnt", "total_pymnt_inv", "out_prncp", "out_prncp_inv",
)

# Fills that do not depend on the data.
CONSTANT_FILLS = {
    "emp_length": "Unknown",
    "emp_title": "Not Provided",
    "mths_since_last_delinq": 999.0,
    "mths_since_last_record": 999.0,
    "mths_since_last_major_derog": 999.0,
}
MODE_FALLBACK = "Unknown"

# The variables that are profiled.
PROFILED_CATEGORIES = (
    "grade", "sub_grade", "term", "home_ownership", "verification_status", "purpose",
    "addr_state", "emp_length", "initial_list_status",
)
PROFILED_NUMBERS = (
    "loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti", "delinq_2yrs",
    "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc",
)

# Columns of a scored file, as far as the input has them.
SCORED_COLUMNS = (
    "id", "member_id", "loan_amnt", "term", "int_rate", "grade", "home_ownership", "annual_inc",
)

# Smoothing, selection range, power labels, gate and points scale.
WOE_SMOOTHING = 0.0001
IV_RANGE = (0.02, 0.5)
POWER_LABELS = ((0.02, "Not useful"), (0.1, "Weak"), (0.3, "Medium"), (0.5, "Strong"))
POWER_ABOVE = "Suspicious"
AUC_THRESHOLD = 0.72
LIFT_THRESHOLD = 0.04
TARGET_SCORE, TARGET_ODDS, POINTS_TO_DOUBLE = 600.0, 50.0, 20.0
RULE_GRADES, RULE_DTI = ("E", "F", "G"), 30.0

# Wording of the verdict on a comparison.
VERDICT_WORDS = ("SUPPORTED", "NOT SUPPORTED")
VERDICT_FORMAT = (
    "%s: {primary} AUC = %.4f, {baseline} AUC = %.4f, lift = %.4f (required >= {lift}), "
    "AUC threshold passed = %s, lift threshold passed = %s")


@dataclass(frozen=True)
class ScorecardSpec:
    """How a scorecard is fitted.

    ``key`` names a column that identifies a row; the exact split and samples hash it. By default rows
    are told apart by all they hold.
    ``fit_on`` says whether imputation, bins and weights see the training rows only
    (``train``) or every row (``all``).
    """

    key: str = "__row"
    target: str = "default_status"
    policy: str = "all_rows"
    status_column: str = "loan_status"
    leakage: tuple[str, ...] = tuple(dict.fromkeys(
        NON_PREDICTIVE_COLUMNS + COLLINEAR_COLUMNS + POST_OUTCOME_COLUMNS
        + PROBLEMATIC_COLUMNS + LEAKAGE_COLUMNS))
    max_bins: int = 10
    max_categories: int = 100
    iv_range: tuple[float, float] = IV_RANGE
    test_share: float = 0.3
    seed: int = 42
    inverse_penalty: float = 0.1
    fit_on: str = "train"
    edge_method: str = "quantile"
    features: tuple[str, ...] | None = None
    fills: dict[str, object] = field(default_factory=lambda: dict(CONSTANT_FILLS))
