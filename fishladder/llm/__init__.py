"""Operators for preparing large text corpora (training data), one module each.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
registers its queries only when it is present.
"""
