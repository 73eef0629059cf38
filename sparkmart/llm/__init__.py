"""Operators of a training-data pipeline (dealt list), their queries and SQL.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds the
queries only when the package is present.
"""
