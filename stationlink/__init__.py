"""stationlink: station-linked incident analytics as plain Spark DataFrame operators.

Every operator takes and returns DataFrames, takes column names as parameters and
runs no Spark action unless its name or docstring says so.
"""

__version__ = "0.1.0"
