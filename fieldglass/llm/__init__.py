"""Operators for preparing training corpora.

Each module holds one operator with a general DataFrame interface; ``queries``
binds them to the standard tables.  Nothing outside this subpackage imports it.
"""
