"""Skylattice: observation tables, time series, labelled grids and forecast
verification as plain Spark DataFrame functions."""

__version__ = "0.1.0"
