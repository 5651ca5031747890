"""Training-data operators: packing, token files, de-duplication, scans, scoring and search.

Nothing else in the library imports this package. ``plinth.llm.queries`` registers one query per operator.
"""
