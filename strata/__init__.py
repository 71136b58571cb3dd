"""strata: a Spark-native event-layer engine.

Events are parsed into a raw (Bronze) table, flattened and cleaned into a
typed (Silver) table, checked against range rules with a quarantine output,
and rolled up into hourly (Gold) facts with event-time tumbling windows.
KPI and health queries read those tables. Every transform is a
``DataFrame -> DataFrame`` function that works unchanged on batch and
streaming DataFrames.
"""

__version__ = "0.1.0"
