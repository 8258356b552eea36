"""Training-data operators over documents, pages and embeddings.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
