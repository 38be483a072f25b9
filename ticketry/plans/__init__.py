"""Whole jobs: load chain, dashboard panels, forecasts, text classification."""
