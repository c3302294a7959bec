"""veilspark: private stream aggregation on Spark.

Tokenize records, bound how much each user contributes, count keys per
trigger and release running histograms under differential privacy, plus
the integrity checks (routes, replay), table sealing and dataset tools
around that core.  Everything is a DataFrame plan; see README.md.
"""

from veilspark.params import PrivacyParams

__all__ = ["PrivacyParams"]
