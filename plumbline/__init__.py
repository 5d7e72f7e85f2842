"""plumbline: table profiling, label audits and model evaluation as Spark jobs.

Every operator is a plain function from DataFrame to DataFrame.  Row-level work
stays on the executors; only bounded statistics (quantiles, class lists, bin
edges, centres) ever reach the driver.
"""

__version__ = "0.1.0"
