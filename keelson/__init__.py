"""keelson: table-maintenance and analytics operators on Spark DataFrames.

Operators are functions from DataFrame to DataFrame; they build a plan and
leave optimisation and execution to Catalyst and adaptive query execution.
"""

__version__ = "0.1.0"
