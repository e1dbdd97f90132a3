"""Plumbline: audited reconciliation of disagreeing operational exports on Spark.

``functions``  column expressions (cleaning, classification, part-number decoding)
``operators``  DataFrame transformations (vote, trust, ledger, repair, geocode, reports, text)
``sources``    readers that return DataFrames with an explicit ``row_no``
``sinks``      writers: fixed-order CSV, JSON, append logs, upserts, snapshots, pages
``streaming``  Structured Streaming forms of the incremental jobs
``plans``      the registered queries over the driver tables, with their SQL checks
"""
