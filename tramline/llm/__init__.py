"""Training-data operators: each module is one operator, ``queries`` registers them on the test tables.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
