"""Small builders of Spark SQL expressions.

They take and return SQL text: one short string per column is parsed once inside Spark, where a
chain of Column calls costs a round trip for every operator.
"""
