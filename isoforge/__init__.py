"""Quality control of single-cell isoform data as Spark jobs."""
