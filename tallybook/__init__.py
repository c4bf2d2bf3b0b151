"""Spark-native operators for customer, branch, product and campaign analytics
over daily banking snapshots.

Every operator takes DataFrames and returns a DataFrame. ``as_of`` dates are
always arguments, every "pick one row" has an explicit tie-break, and many
processing days are handled in one plan instead of a driver loop.
"""
