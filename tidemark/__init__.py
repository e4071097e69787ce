"""Spark-native sales lakehouse operators.

Raw delimited tables are conformed, kept as slowly changing history, merged
into dimensions and a fact table, and summarised per month. Every operator
takes and returns DataFrames; nothing here runs a row at a time in Python.
"""
