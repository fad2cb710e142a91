"""Commerce lakehouse building blocks for PySpark."""
