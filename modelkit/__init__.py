"""Analytical data-modelling operators for PySpark: DataFrame in, DataFrame out."""
