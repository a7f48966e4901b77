"""The parameters of a run. Every operator is a function of its tables and these; there is no wall clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

#: Days of the cohort ladder that may be configured, and the boundaries of lag buckets.
LADDER_DAYS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 45, 60, 90)
BOUNDARY_DAYS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 21, 30, 45, 60, 90)


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(1998, 6, 30)
    run_id: str = "run-19980630"
    window_days: int = 90
    reporting_window_days: int = 90
    cohort_days: tuple[int, ...] = (0, 1, 3, 5, 7, 14, 30)
    restatement_margin_days: int = 7
    #: How far scores, campaign sums, sums over grains and single assets may be off.
    allowed: tuple[tuple[str, float], ...] = (("parity", 0.01), ("campaign", 0.01), ("grain", 0.01), ("asset", 0.01))

    def __post_init__(self) -> None:
        bad = set(self.cohort_days) - set(LADDER_DAYS)
        if bad:
            raise ValueError(f"cohort days outside the ladder: {sorted(bad)}")
        if self.window_days < 0 or self.reporting_window_days < 1:
            raise ValueError("windows must not be negative")

    @property
    def window_start(self) -> dt.date:
        return self.as_of - dt.timedelta(self.window_days)

    @property
    def tolerances(self) -> dict[str, float]:
        return dict(self.allowed)

    def warnings(self) -> list[str]:
        """What is legal but leaves cells of the cohorts without an answer, or lets old observations go unread."""
        needed = 1 + self.restatement_margin_days + max((0, *self.cohort_days))
        says = {
            f"no lag bucket ends at day {self.reporting_window_days}": self.reporting_window_days not in BOUNDARY_DAYS,
            f"the last rung with its margin takes {needed} days": needed > self.reporting_window_days,
        }
        return [text for text, holds in says.items() if holds]
