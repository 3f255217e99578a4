"""Training-data operators on Spark: one module per operator.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
