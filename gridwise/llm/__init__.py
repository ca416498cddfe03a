"""Training-data pipeline operators (see ``queries.py`` for the registered queries).

Nothing else in the library imports this subpackage.
"""
