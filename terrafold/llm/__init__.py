"""Training-data operators: ten corpus-scale components on Spark.

Each module holds one operator with its own general interface; ``queries``
holds the thin ``opN_*`` queries registered by the entry module.  Nothing
outside this package imports it.
"""
