"""veilspark.streaming."""
