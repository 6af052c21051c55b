"""barloom: end-of-day price-bar analytics written as PySpark DataFrame jobs."""
