"""Public-offering analytics as Spark jobs.

Sub-packages: ``sources`` (tables in and out), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame building blocks), ``plans`` (the jobs and reports),
``streaming`` (incremental ingest) and ``cases`` (inputs derived from generic tables,
used by the checks and the benchmark).
"""
