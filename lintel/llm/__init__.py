"""Training-data operators: thirteen Spark jobs for text, page and vector corpora.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
