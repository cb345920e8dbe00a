"""Model-driven data jobs on PySpark.

A declared relational and document model is put to work on data: types, keys,
checks, defaults, sequences, nested documents, snapshot differences, schema
evolution and partition layouts, each as a ``DataFrame -> DataFrame`` function.
"""
