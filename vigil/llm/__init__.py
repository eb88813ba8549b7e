"""Training-data pipeline operators (texts, pages, conversations).

Each module holds one operator with its general interface; ``registry`` adds
the thin ``opN_*`` queries.  Nothing else in the library imports this
subpackage.
"""
