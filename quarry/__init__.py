"""quarry: batch text, time-ordering and data-migration jobs on Spark DataFrames.

Every operator is a function from DataFrames to DataFrames built from Spark SQL
expressions; the driver sees counts, a convergence figure, and one row per state
and transition of the migration model.
"""

__version__ = "0.1.0"
