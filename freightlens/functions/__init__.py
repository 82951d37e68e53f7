"""Expressions over columns. All of them are built-in Spark expressions, no Python UDF.

Where an expression is longer than a call or two it is written as SQL text. The
functions that end in ``_sql`` return such text, the others a Column.
"""
