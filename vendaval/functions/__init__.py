"""Column-to-column helpers. Nothing here triggers a job."""
