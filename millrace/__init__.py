"""Ready-made table and stream operations for Spark.

Every operation is a plain function from DataFrame to DataFrame.  Unless a
docstring says otherwise the same function serves batch and streaming frames.
"""
