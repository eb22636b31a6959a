"""Railway ticketing analytics on PySpark: reports, listings, look-ups and batch jobs."""
