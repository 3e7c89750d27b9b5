"""Training-data operators: scoring, deduplication, mixing, tokenisation, sharding.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
