"""Training-data operators (deduplication, filtering, tokenisation, packing).

Nothing else in the library imports this subpackage.
"""
