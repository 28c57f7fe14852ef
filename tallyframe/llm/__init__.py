"""Operators of a training-data pipeline, one module each; queries in ``queries``.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
