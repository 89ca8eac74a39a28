"""Operators for building language-model training data on Spark.

Nothing outside this subpackage imports it. Each module holds one operator
with its own general interface; :mod:`snapledger.llm.queries` registers one
``opN_<name>`` query per operator.
"""
