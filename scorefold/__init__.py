"""Consumer scoring, feature-store and reconciliation operators for PySpark.

Operators are lazy ``DataFrame -> DataFrame`` functions meant to be chained
with ``DataFrame.transform``; see README.md for the operator index.
"""

__version__ = "0.1.0"
