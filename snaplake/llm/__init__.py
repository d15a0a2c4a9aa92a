"""Operators for preparing training data: one module per operator, plus the
registered queries in :mod:`snaplake.llm.queries`. Nothing else in the library
imports this subpackage."""
