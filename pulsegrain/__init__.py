"""Review-text analytics on PySpark.

Every operator is a function from DataFrame to DataFrame (or from Column to
Column), so a job is an ordinary chain of DataFrame transformations.
"""
