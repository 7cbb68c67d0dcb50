"""Operators for training-data pipelines: dedup, search, mixing, scans, archives.

Every operator is ``f(df, ..., params) -> DataFrame`` with real outputs; the
contract's digest columns are derived in :mod:`catalogflow.llm.queries`.
Nothing outside this folder imports it.
"""
