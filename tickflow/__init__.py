"""Price-tick analytics on PySpark, for tables and for streams."""
