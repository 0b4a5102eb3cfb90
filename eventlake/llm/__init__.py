"""Operators for large training-data pipelines, one module per operator.

Nothing else in the package imports this subpackage; its queries live in
``eventlake.llm.catalog``.
"""
