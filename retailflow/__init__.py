"""retailflow: retail data operators on the PySpark DataFrame API."""
