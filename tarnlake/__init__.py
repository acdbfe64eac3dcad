"""tarnlake: lakehouse ingestion, modelling, change capture and analytics on PySpark.

Every operator is a DataFrame-to-DataFrame function (or a Structured Streaming
query) that only declares a plan; Catalyst and AQE choose how to run it.
"""
