"""Operators of a training-data pipeline: filters, deduplication, tokenizers, fingerprints.

Nothing else in the package imports this subpackage.  Each module holds one
operator with its own interface; ``hearth.llm.queries`` registers the queries
over the ``documents pages benchmark labels conversations`` tables.
"""
