"""Describes a wide participant panel: which columns hold which visit."""

from __future__ import annotations

from dataclasses import dataclass, field

from . import presets as P


@dataclass(frozen=True)
class PanelSpec:
    """Names of a wide panel with one row per participant.

    Visit ``k`` of feature ``f`` lives in column ``v{k}_{f}``; the age at
    visit ``k`` in ``as{k}_age``. ``binary`` and ``ternary`` name the nominal
    features whose change is coded as a transition rather than a difference.
    """

    features: tuple = P.LONGITUDINAL_FEATURES
    binary: tuple = P.BINARY_FEATURES
    ternary: tuple = P.TERNARY_FEATURES
    base_columns: tuple = P.BASE_COLUMNS
    n_visits: int = P.N_VISITS
    id_col: str = P.ID_COL
    status_columns: tuple = P.STATUS_COLUMNS
    sentinel: float = P.MISSING_SENTINEL
    threshold: float = P.SENTINEL_THRESHOLD
    drug_drop_columns: tuple = field(default=P.DRUG_BASELINE_DROP_COLUMNS)

    def __post_init__(self):
        unknown = [f for f in self.binary + self.ternary if f not in self.features]
        if unknown:
            raise ValueError(f"nominal features not in the feature list: {unknown}")
        if self.n_visits < 2:
            raise ValueError("a panel needs at least two visits")

    @staticmethod
    def feature_col(visit: int, feature: str) -> str:
        return f"v{visit}_{feature}"

    @staticmethod
    def age_col(visit: int) -> str:
        return f"as{visit}_age"

    def visits(self):
        return range(1, self.n_visits + 1)

    def n_levels(self, feature: str) -> int | None:
        if feature in self.binary:
            return 2
        if feature in self.ternary:
            return 3
        return None

    @property
    def nominal(self) -> tuple:
        return self.binary + self.ternary

    @property
    def categorical_columns(self) -> tuple:
        """Columns imputed with the mode: baseline, nominal levels and codes."""
        return (self.base_columns + self.binary + self.ternary
                + tuple(f"{f}_diff" for f in self.binary)
                + tuple(f"{f}_diff" for f in self.ternary))

    def required_columns(self) -> list:
        cols = [self.id_col, *self.status_columns, *self.base_columns]
        cols += [self.age_col(k) for k in self.visits()]
        cols += [self.feature_col(k, f) for k in self.visits() for f in self.features]
        return cols

    def interval_columns(self) -> list:
        return ([self.id_col, "visit", "label", *self.base_columns, "age", *self.features]
                + [f"{f}_diff" for f in self.features])


STUDY = PanelSpec()
