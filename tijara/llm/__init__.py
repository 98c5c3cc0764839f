"""Operators of a training-data pipeline over a table of documents (``doc_id``, ``text``).

Nothing else in the library imports this subpackage. Every operator reads only the columns it
names, so extra columns of its input never clash with its own.
"""
