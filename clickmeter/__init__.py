"""Click analytics as Spark DataFrame jobs: capture, archive, count, reconcile, serve."""
