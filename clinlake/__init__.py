"""Clinical-document lakehouse built from ordinary Spark DataFrame code.

``sources``    readers that turn files and pushed records into rows
``functions``  Column-level helpers (document paths, extractors, natural keys)
``operators``  DataFrame-level helpers (explode, keyed upsert, joins, quality)
``plans``      table definitions: silver, gold, mart, metric views, CSV, ADT
``streaming``  Structured Streaming wrappers and keyed append logs
"""
