"""Operators for preparing large-scale training data.

Each module holds one operator with its own general interface; the thin
``opN_<name>`` queries over the driver tables are in ``queries.py``. Nothing
outside this package imports it.
"""
