"""shelfmark: circulation analytics (cleaning, record linkage, star schema,
quality checks, profiling and analytic questions) as Spark DataFrame operators.

Every operator takes and returns DataFrames and takes column names as
parameters, so the same code runs on library feeds and on the driver tables.
"""

__version__ = "0.1.0"
