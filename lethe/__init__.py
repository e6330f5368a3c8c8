"""Data retention, purge and column masking as Spark jobs."""
