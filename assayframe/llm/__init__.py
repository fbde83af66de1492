"""Operators for training-data pipelines. Nothing else in the library imports this package.

Common rules, unless an operator says otherwise: a null text counts as an empty one, a null
doc_id is kept as it is, repeated rows are each answered, an empty table gives an empty result,
and columns that an operator does not name are not looked at, whatever they are called.
"""
