"""studyflow: Spark-native study warehouse transformations.

``functions``  column expressions (no Python UDFs)
``operators``  DataFrame -> DataFrame transformations
``sources``    file / table scans and sinks
``streaming``  incremental folder load on Structured Streaming
``plans``      the registered demonstration queries with their SQL checks
"""
