"""Operators of a training-data pipeline: packing, scoring, filters, deduplication.

One module for each operator; ``queries`` registers the thin queries over the
driver tables.  Nothing outside this package imports it, except the guarded
import in ``__spark_entry__`` and ``corpus_pipeline``.
"""
