"""Operators of a training-data pipeline over ``documents``, ``embeddings``, ``benchmark`` and ``labels``.

Nothing else in the package imports this one.
"""
