"""Spark-native terrain and feature analytics.

Rasters are cell or block tables, features are tables with WKB geometry, and
every operator is a DataFrame plan that Catalyst can optimise.
"""

__version__ = "0.1.0"
