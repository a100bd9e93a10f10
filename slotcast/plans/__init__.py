"""Composite plans: what a forecasting job runs, built from the operators."""
