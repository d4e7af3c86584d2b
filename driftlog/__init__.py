"""driftlog: multi-tenant log analytics on Spark DataFrames and Structured Streaming.

Every operator is a plain function over DataFrames; see README.md for the map.
"""

__version__ = "0.1.0"
