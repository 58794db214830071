"""Operators that prepare text corpora for language-model training.

Nothing outside this subpackage imports it. Every operator is a function on DataFrames;
``queries`` registers one query per operator.
"""
