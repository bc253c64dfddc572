"""Operators for building training corpora: counting, encoding, sharding, filtering, deduplication, decontamination.

Nothing else in the library imports this subpackage. Every operator takes and returns DataFrames and names the
columns it reads; other columns are left alone. A null text is an empty text unless the operator says otherwise.
"""
