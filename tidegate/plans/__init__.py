"""Flows built from the operators: mart, spool, loads and the whole day."""

from tidegate.plans.mart import build_mart
from tidegate.plans.spool import build_spool

__all__ = ["build_mart", "build_spool"]
