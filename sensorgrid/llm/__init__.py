"""Training-data operators over ``documents``-like tables.

One module per operator; :mod:`sensorgrid.llm.queries` holds the thin registered queries.
Nothing else in the library imports this package.
"""
