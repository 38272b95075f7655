"""Sales warehouse and analytics built on the Spark DataFrame API.

Raw files become cleaned tables, cleaned tables become a star schema, and the
analytic questions are functions from DataFrames to a DataFrame.
"""
