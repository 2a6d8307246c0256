"""Transaction lakehouse analytics on open-source Spark."""
