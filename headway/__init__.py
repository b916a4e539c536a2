"""headway: service-reliability analytics on Spark.

Incident records are cleaned, joined to hourly weather, aggregated into
route/day, route/hour, weather, network and route-risk tables, turned into
labelled two-hour windows for a degradation classifier, and scored against a
seven-day forecast.  Everything is DataFrame / Spark SQL / Spark ML code.
"""

__version__ = "0.1.0"
