"""Operators of a training-data pipeline over the tables ``documents``,
``labels`` and ``pages``. Nothing else in the library imports this package."""
