"""Cost-versus-quality analytics as composable PySpark DataFrame functions.

``functions``  Column expressions (casts, suppression, classification, statistics)
``operators``  DataFrame -> DataFrame operators (aggregate, reshape, join, check)
``sources``    scans of paged JSON, preamble CSV, nested JSON, zip, catalogs
``sinks``      raw landing, materialisation, flat export, stored failures
``plans``      the hospital and price models, and the queries on the test tables
"""
