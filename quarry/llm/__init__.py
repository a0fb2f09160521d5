"""Training-data operators: tokenisation, packing, search, filters, scoring and near-duplicate joins.

Nothing else in the library imports this package.
"""
