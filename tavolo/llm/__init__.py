"""Training-data operators for document corpora.

Nothing else in the library imports this package; it can be removed without
touching the rest. ``queries.QUERIES`` and ``queries.ORACLE`` hold the
registered queries.
"""
