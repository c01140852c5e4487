"""Training-data operators for very large text corpora.

Nothing else in the library imports this package; ``queries`` registers one
query per operator.
"""
