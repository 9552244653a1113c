"""Training-data operators on documents, pages and embeddings.

Nothing else in the library imports this package; ``queries`` registers one query per
operator. Operators take and return DataFrames and keep every row they are given.
"""
