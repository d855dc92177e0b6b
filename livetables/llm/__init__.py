"""Operators for preparing training data at scale.

One module per operator; `queries` holds the registered queries and their SQL.
Nothing else in the library imports this subpackage.
"""
