"""Training-data operators: tokens, de-duplication, classifiers, search, sharding and mixing.

Nothing outside this package imports it. Every operator is a function on DataFrames with a general interface; the
`CHECKS` of `bazaarspark.llm.registry` apply them to the given tables.
"""
