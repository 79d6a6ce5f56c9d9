"""Clinical time-series analytics on Spark.

DataFrame in, DataFrame out: as-of, nearest and interval joins, event-log pivots, episodes,
hourly severity grids, harmonising unions and the reports built on them.
"""
