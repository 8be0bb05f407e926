"""Composed plans: the preset pipeline, published queries, the query
catalogue and the SQL used as a cross-engine oracle."""
