"""Operators of a training-data pipeline over tables of documents, pages and embeddings.

Nothing else in the library imports this subpackage. Each module holds one operator;
``queries`` applies them to whole tables, ``oracles`` has the SQL they must agree with.
"""
