"""Training-data operators: packing, de-duplication, search, filtering, mixing.

Nothing else in the library imports this subpackage.  Operators take and
return DataFrames; ``queries.py`` registers one query per operator.
"""
