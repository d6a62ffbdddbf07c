"""Training-data operators over the ``documents`` and ``embeddings`` tables.

Nothing outside this package imports it; ``__spark_entry__.py`` registers its
queries only when it can be imported.
"""
