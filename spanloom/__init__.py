"""spanloom: stand-off annotation analytics on PySpark."""
