"""Training-data operators: the ten dealt operators, their queries and the corpus pipeline's stages.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
