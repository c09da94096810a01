"""End-to-end jobs and the query catalogue."""
