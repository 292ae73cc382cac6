"""riskloom: tabular risk analytics as Spark jobs.

Operators take and return DataFrames.  Facts about a table that later steps
need as constants (medians, fences, thresholds) are found by Spark first and
come back as a few rows per column, in the way ML estimators are fitted.
"""

__version__ = "0.1.0"
