"""tripkit: trip-record analytics on Spark DataFrames.

Layers: ``sources`` (schemas, scans, loads, sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (staging, marts, dashboard and report results, build order) and
``streaming`` (incremental landing-folder load).
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
