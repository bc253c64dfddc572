"""How this library declares its Python functions."""

from __future__ import annotations


def once(udf):
    """Keep the optimizer from copying a Python function into the expressions that use its result.

    A column that feeds a lambda (``transform``, ``filter``) would otherwise drag the function
    call into the lambda, where Spark cannot run it, and a filter on the column could run it twice.
    """
    return udf.asNondeterministic()
