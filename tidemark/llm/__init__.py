"""Operators for training-data pipelines: text rules, joins, scores, samples and codes.

Nothing else in the package imports this folder; ``__spark_entry__.py`` adds its queries
when it is there.
"""
