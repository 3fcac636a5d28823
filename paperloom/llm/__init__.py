"""Training-data operators: cleaning, deduplication, screening, encoding.

Every module holds one operator with a general interface, the thin query that
applies it to the corpus tables, and its SQL where SQL can state it.
"""
