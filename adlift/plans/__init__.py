"""Whole-job plans: the run calendar and the daily conversions plan."""
