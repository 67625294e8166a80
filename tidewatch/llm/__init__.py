"""Training-data operators: fingerprints, deduplication, packing, tokenising,
classification and search over ``documents`` and ``embeddings``.

Nothing else in the library imports this subpackage.
"""
