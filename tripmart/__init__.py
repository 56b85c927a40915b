"""Trip-record analytics on Spark: clean, aggregate, profile, enrich and model trips.

Every operator is a plain ``DataFrame -> DataFrame`` function, so it composes with
``df.transform`` and leaves physical planning to Catalyst.
"""
