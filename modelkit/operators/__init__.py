"""Modelling operators, grouped by the kind of table they build."""
