"""Project-finance and platform-event analytics on PySpark."""
