"""Training-data operators: cleaning, de-duplication, scanning and tokenising of text at scale.

Nothing outside this sub-package (and ``corpus_pipeline.py``) imports it.
"""
