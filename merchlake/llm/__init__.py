"""Operators for preparing large text corpora.

One module per operator; ``queries`` registers one query for each.  Nothing
else in the library imports this subpackage.
"""
