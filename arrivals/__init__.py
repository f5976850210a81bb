"""Arrivals warehouse on Spark.

Raw arrival records and their companion datasets become a checked star schema
(an arrivals fact table with demographics, temperature and airport
dimensions), expressed entirely with the DataFrame API.

Entry points: ``arrivals.plans.run`` (end-to-end run and one call per
dataset), ``arrivals.plans.builds`` (table builds and publishing),
``arrivals.streaming`` (incremental monthly drops).
"""

__version__ = "0.1.0"
