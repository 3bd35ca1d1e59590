"""lognorm: heterogeneous raw log lines to validated OCSF 1.3 events, on Spark."""
