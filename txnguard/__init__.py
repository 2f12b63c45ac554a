"""txnguard: payment-transaction risk scoring expressed as Spark DataFrame,
MLlib and Structured Streaming plans.

Sub-packages:
  sources/    readers, fixture views derived from the driver tables, parsing, sinks
  functions/  column expressions (z-scores, calendar, haversine, epoch micros)
  operators/  enrichment joins, velocity, rules, geo-velocity, dedup, ML stages
  plans/      the end-to-end scoring plan and the registered query catalogue
  streaming/  foreachBatch scoring job, stateful trailing velocity, stream windows
"""

from txnguard.config import FixtureSpec, ModelConfig, ScoringConfig

__all__ = ["FixtureSpec", "ModelConfig", "ScoringConfig"]
