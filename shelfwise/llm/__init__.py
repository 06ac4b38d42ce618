"""Operators of a training-data pipeline over text tables.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries, ``oracles`` their SQL; every other module is one operator
with its own general interface.
"""
