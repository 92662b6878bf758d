"""Training-data operators: language id, quality, toxicity, near-duplicates,
mixing, token counts, packing and vector search, as Spark jobs.

Each module holds one operator with a general interface; ``queries`` holds
the registered ``opN_*`` forms over the driver's tables.
"""
