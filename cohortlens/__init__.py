"""Longitudinal cohort analytics on Spark DataFrames."""

from .spec import PanelSpec, STUDY

__all__ = ["PanelSpec", "STUDY"]
