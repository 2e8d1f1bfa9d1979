"""Column names and analysis parameters.

Column names are configuration: three are required (date, donor id,
amount); every other logical column is optional and operators skip the
ones a frame does not carry.  Defaults mirror the reference job's
defaults so a user switching over gets the same numbers.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class ColumnMap:
    date: str = "Date"
    donor_id: str = "ID"
    amount: str = "Amount"
    seq: str = "ReceiptSeq"  # tiebreak for "last" among equal dates
    gender: str | None = "Gender"
    birthdate: str | None = "BirthDate"
    suburb: str | None = "Suburb"
    state: str | None = "State"
    postcode: str | None = "PostCode"
    occupation_desc: str | None = "OccupDesc"
    religion: str | None = "ReligionCode"
    education: str | None = "Education"
    appeal: str | None = "Appeal"
    fund: str | None = "Fund"
    appeal_desc: str | None = "AppealDescription"
    fund_desc: str | None = "FundDescription"
    current_parent: str | None = "CurrentParent"
    future_parent: str | None = "FutureParent"
    past_parent: str | None = "PastParent"
    past_student: str | None = "PastStudent"

    @property
    def flags(self) -> list[str]:
        """Relationship flags in reference order (CP, FP, PP, PS)."""
        return [c for c in (self.current_parent, self.future_parent,
                            self.past_parent, self.past_student) if c]

    @property
    def relationship(self) -> list[str]:
        """Relationship flags in report order (CP, PP, PS, FP)."""
        return [c for c in (self.current_parent, self.past_parent,
                            self.past_student, self.future_parent) if c]

    @property
    def categoricals(self) -> list[str]:
        return [c for c in (self.gender, self.suburb, self.state, self.postcode,
                            self.occupation_desc, self.religion, self.education,
                            self.appeal, self.fund, self.appeal_desc,
                            self.fund_desc) if c]

    @property
    def demographics(self) -> list[str]:
        """Demographic model features, categorical first then flags."""
        return [c for c in (self.gender, self.occupation_desc, self.religion,
                            self.state, self.education, self.current_parent,
                            self.past_parent, self.past_student) if c]


@dataclass(frozen=True)
class AnalysisParams:
    rfm_quantiles: tuple[float, ...] = (0.2, 0.4, 0.6, 0.8)
    year_cutoff: int = 2000
    redonate_window_days: int = 365
    panel_step_months: int = 6          # "2Q": every second quarter end
    min_panel_start: _dt.datetime = _dt.datetime(2000, 1, 1)
    major_gift_threshold: float = 1000.0
    lapsed_recency_days: int = 730
    lapsed_min_monetary: float = 200.0
    new_donor_days: int = 90
    upgrade_multiplier: float = 1.5
    upgrade_min_frequency: int = 2
    upgrade_recent_days: int = 365
    lapsed12_recency_days: int = 365
    lapsed12_min_monetary: float = 100.0
    sleeper_recency_days: int = 365
    sleeper_min_monetary: float = 500.0
    train_ratio: float = 0.8
    test_size: float = 0.25
    random_state: int = 42
    min_samples_for_training: int = 200
    top_n_categories: int = 50
    rfm_reference: _dt.datetime | None = None
    demographics_asof: bool = False     # reference leaks later demographics
    exact_quantiles: bool = True        # False -> percentile_approx

    def with_(self, **kw) -> "AnalysisParams":
        return replace(self, **kw)


@dataclass(frozen=True)
class ModelParams:
    lr_max_iter: int = 5000
    lr_tol: float = 1e-4                # the reference's solver tolerance (library default)
    rf_n_estimators: int = 300
    rf_max_depth: int = 10              # sklearn grows unlimited depth; Spark caps at 30 and
                                        # grows level-wise, so deep forests cost 2^depth work
    gbt_n_estimators: int = 300
    gbt_learning_rate: float = 0.05
    time_rf_n_estimators: int = 500
    amount_rf_n_estimators: int = 200
    preference_n_estimators: int = 400
    max_bins: int = 32
    max_labels: int = 1000              # categories with more labels are binned by hash
    max_memory_mb: int = 1024           # nodes split per data pass (fewer passes)
    task_rows: int = 8_000              # training rows a task has at least, and at most
    most_task_rows: int = 500_000
    tree_rows: int = 250_000_000        # rows x trees grown at a time
    part_trees: int = 64                # trees grown at a time, where rows x trees
    part_rows: int = 40_000_000         # of a part come to this
    seed: int = 42

    def with_(self, **kw) -> "ModelParams":
        return replace(self, **kw)


@dataclass(frozen=True)
class Settings:
    columns: ColumnMap = field(default_factory=ColumnMap)
    analysis: AnalysisParams = field(default_factory=AnalysisParams)
    models: ModelParams = field(default_factory=ModelParams)


DEFAULT = Settings()


class InsufficientData(ValueError):
    """A documented training guard failed (too few rows, classes or dates)."""
