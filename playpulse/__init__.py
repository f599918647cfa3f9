"""playpulse: gameplay telemetry analytics written as plain PySpark DataFrame jobs.

Layout
------
- ``playpulse.config``      session + job configuration (environment driven)
- ``playpulse.schema``      event envelope, curated table and metric table schemas
- ``playpulse.functions``   Column -> Column helpers (rules, rates, hashing, suppression)
- ``playpulse.operators``   DataFrame -> DataFrame metric builders
- ``playpulse.sources``     readers / writers (JSON lines, partitioned tables, serving store)
- ``playpulse.streaming``   Structured Streaming ingest
- ``playpulse.plans``       composite jobs (quality gate, build, publish, daily run)
"""

__version__ = "0.1.0"
