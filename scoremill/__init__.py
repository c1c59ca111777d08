"""Binary-outcome scorecards as Spark jobs: clean, profile, bin, weigh, model, score, evaluate."""

from scoremill.plans.scorecard import ScorecardModel, fit_scorecard
from scoremill.sources.session import tuned
from scoremill.spec import ScorecardSpec

__all__ = ["ScorecardModel", "ScorecardSpec", "fit_scorecard", "tuned"]
