"""tripyard: a Spark-native trip-records lakehouse.

Batch Parquet + zone CSV + a JSON event stream -> validated, de-duplicated,
cleaned and enriched silver trips -> gold summaries, ranked analytics and
data-quality gates, all as DataFrame / Structured Streaming plans.
"""

__version__ = "0.1.0"
