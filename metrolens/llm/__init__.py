"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``embeddings``.

Each module holds one operator with its own general interface and the thin
``opN_<name>`` query that applies it to a whole table. Nothing outside this
subpackage imports it.
"""
