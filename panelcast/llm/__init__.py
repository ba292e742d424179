"""Training-data pipeline operators (deduplication, filtering, tokens, packing).

Nothing else in the library imports this subpackage; it uses the library's
session helpers only.
"""
