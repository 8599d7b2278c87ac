"""Operators for preparing large text corpora, and their registered queries.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing outside this package imports it except the guarded registration in
``__spark_entry__.py`` and the corpus pipeline.
"""
