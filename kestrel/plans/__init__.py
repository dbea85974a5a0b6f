"""End-to-end jobs and the query registry over the shared test tables."""
