"""larder: demand planning over daily product-by-warehouse panels, on Spark.

Every stage is a function from DataFrames to a DataFrame.  Nothing in the
package collects a table to the driver; the few driver-side values (row counts
of a verified load, a check report of a few dozen rows) are bounded by the
number of tables or parameters, never by the data.
"""

__version__ = "1.0.0"
