"""Loads that start when ready files arrive."""

from tidegate.streaming.arrivals import arrivals, judge_arriving_transfers, load_on_arrival

__all__ = ["arrivals", "judge_arriving_transfers", "load_on_arrival"]
