"""clickmart: shop clickstream analytics as Spark DataFrame functions.

Every function takes and returns DataFrames (or Columns); none builds a session, and every
path, credential and size is a parameter.
"""
