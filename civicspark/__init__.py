"""Legislative open-data analytics on PySpark."""
