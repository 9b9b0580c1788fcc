"""Scriptorium: text provenance analytics on Spark DataFrames.

Column functions live in ``functions``, DataFrame operators in ``operators``,
readers and writers in ``sources``, stream wiring in ``streaming`` and the
compositions over whole tables in ``plans``.
"""

__version__ = "0.1.0"
