"""Reports, listings, views, batch jobs and data quality."""
