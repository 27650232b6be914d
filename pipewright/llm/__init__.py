"""Operators of a training-data pipeline.

One module per operator, each with its general function (own parameters, real
outputs: texts, ids, spans, pairs) and the thin ``opN_<name>`` query of the
driver contract.  ``queries`` lists the queries and the SQL of those that SQL
can express.  Nothing else in the library imports this package.
"""
