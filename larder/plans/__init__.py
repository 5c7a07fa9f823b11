"""The derived panel, the query registry and the end-to-end jobs."""
