"""Repeat-purchase analytics on Spark DataFrames.

Raw commerce tables go in; one row per customer at their first purchase, a
repeat-purchase label, a fitted logistic regression and exact evaluation tables
come out.  ``encore.plans`` holds the end-to-end flows, ``encore.operators`` the
steps they are made of.
"""
