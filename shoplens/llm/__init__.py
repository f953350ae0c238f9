"""Operators for preparing training text: quality, near copies, leaks, secrets, packing.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
