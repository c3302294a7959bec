"""veilspark.functions."""
