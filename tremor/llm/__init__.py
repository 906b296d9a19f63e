"""Training-data operators: filtering, deduplication, formatting and token output.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports
from here.
"""
