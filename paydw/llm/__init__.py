"""Training-data operators: ten operators on text, token and vector tables.

Each module holds one operator with a general interface; ``queries`` registers
one query per operator and its oracle SQL. Nothing outside this folder (but the
guarded import in ``__spark_entry__.py`` and ``corpus_pipeline.py``) uses it.
"""
