"""SQL counterparts of the named queries, written independently of the operators.

They use the plain forms: self-joins for retention, ``rank()`` for rank tests, three
separate cuts for the mart, full windows for running numbers.
"""
