"""Operators of a training-data pipeline: URL filtering, source mixing,
quality and toxicity scoring, tokenising, near-duplicates, nearest
neighbours, page extraction, language identification and fingerprints.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLES`` hold the registered queries.
"""
