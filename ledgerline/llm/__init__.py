"""Operators for training-data pipelines over ``documents``, ``pages`` and
``embeddings``.

Each module holds one operator with its general interface; ``queries.py``
binds the operators to the supplied tables as ``opN_<name>``.  Nothing else in
the library imports this subpackage.
"""
