"""lakegate: configuration-driven file ingestion with data-quality control on Spark.

Entry points: ``lakegate.plans.ingest.Ingestion`` (batch run / stream), the
operators in ``lakegate.operators`` (DataFrame in, DataFrame out) and the
command line ``python -m lakegate``.
"""

__version__ = "0.1.0"
