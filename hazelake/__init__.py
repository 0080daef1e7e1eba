"""Air-quality lakehouse operators expressed as Spark DataFrame plans.

Entry points:
  hazelake.plans.pipeline   cleaned() / silver() / gold() as lazy DataFrame transforms
  hazelake.plans.jobs       run_batch(): bronze -> silver -> gold for a date range (CLI: -m)
  hazelake.streaming.jobs   the readings/alert consumer and the hourly archiver (CLI: -m)
  hazelake.operators.*      individual operators (dedupe, quantiles, outliers, facts, ...)
  hazelake.functions.*      Column-expression builders (AQI, units, time, text, SQL functions)
"""

__version__ = "0.1.0"
