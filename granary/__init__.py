"""Daily-batch warehouse operators for PySpark."""
