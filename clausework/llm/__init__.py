"""Operators of a training-data pipeline: extraction, language, duplicates, mixing, packing, search.

Nothing outside this subpackage imports it. ``queries`` registers one query
per operator; each module holds one operator with its own general interface.
"""
