"""Retail analytics and daily revenue forecasting as PySpark plans.

Every operator takes DataFrames and returns a DataFrame; nothing runs until the
caller acts on the result, apart from model fitting and the documented
``materialise`` points.
"""

__version__ = "0.1.0"
