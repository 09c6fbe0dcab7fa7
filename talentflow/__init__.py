"""talentflow: job-posting analytics expressed as Spark DataFrame plans.

Layers:
  sources/    landed provider responses -> Bronze rows, table sinks (append,
              snapshot upsert, overwrite)
  functions/  Column-level functions (text normalisation, term extraction,
              scoring); all are built-in Spark expressions, no Python UDFs
  operators/  DataFrame -> DataFrame operators (normalisation, latest row per
              key, Gold views, matching)
  plans/      end-to-end jobs (Bronze -> Silver) and inputs derived from the
              benchmark tables
  streaming/  the landing -> Bronze append as a Structured Streaming query
"""

__version__ = "0.1.0"
