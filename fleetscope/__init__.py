"""fleetscope: Spark-native fleet telemetry analytics.

Every operator is a function from DataFrame(s) to a DataFrame. The heavy
work (scans, shuffles, aggregates, windows, streaming state) runs on Spark;
only bounded scalars (fitted model parameters, thresholds) reach the driver.
"""

__version__ = "0.1.0"
