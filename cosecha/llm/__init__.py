"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage; its queries are in
``cosecha.llm.queries`` and are registered only when it can be imported.
"""
