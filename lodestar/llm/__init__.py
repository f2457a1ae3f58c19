"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``labels``.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries when it is present.
"""
