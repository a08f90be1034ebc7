"""settlekit: two-sided payment-transaction analytics on Spark.

Entry points: ``settlekit.plans.model.Model`` (the lakehouse model),
``settlekit.operators`` (promotion, reconciliation, dimensions, mart, charts,
checks, audits), ``settlekit.sources`` and ``settlekit.streaming`` (feeds),
``settlekit.plans.pipeline.run_pipeline`` (the daily job).
"""

__version__ = "0.1.0"
