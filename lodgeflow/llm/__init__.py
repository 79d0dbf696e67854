"""Operators of a large-scale training-data pipeline (documents, pages, labels).

Nothing outside this folder imports it; ``llm.registry`` holds its queries and
their DuckDB SQL.
"""
