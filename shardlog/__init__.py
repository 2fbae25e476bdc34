"""Record-stream operators for PySpark.

A record stream is an append-only, sharded sequence of keyed messages with an
opaque payload.  Every operator here is a function from DataFrame to DataFrame
(or starts a streaming query) and works on all shards at once.
"""
