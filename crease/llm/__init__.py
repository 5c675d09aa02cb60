"""Operators for preparing language-model training corpora, built on Spark DataFrames.

Each module holds one operator with its own general interface; ``queries`` registers thin
``opN_<name>`` queries over the tables ``documents`` and ``conversations``.
"""
