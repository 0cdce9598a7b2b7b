"""The composite jobs."""
