"""Training-data operators on Spark: mixing, search, scoring, extraction, archives, tokens, near-duplicates.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
