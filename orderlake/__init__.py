"""orderlake: a retail-order lake on Spark DataFrames, Spark SQL and Structured Streaming.

Zones (bronze / silver / gold), cleaning, data-quality rules, governed views,
a star schema with direct file queries, a streaming medallion path and SQL
dashboards.  Every operator takes and returns DataFrames; nothing in the data
path collects rows to the driver.
"""

__version__ = "0.1.0"
