"""Scorecard report, registered with the dates of the test tables."""

from __future__ import annotations

from datetime import date

from revtrellis.catalog.registry import AS_OF, query
from revtrellis.catalog.scorecards import SCORECARD
from revtrellis.plans import reports

SPEC = reports.ScorecardSpec(from_date=date(1997, 7, 1), snapshot=date(1998, 5, 4))


@query("pipe_scorecard", SCORECARD)
def _(s):
    return reports.rep_scorecard(s, AS_OF, SPEC)
