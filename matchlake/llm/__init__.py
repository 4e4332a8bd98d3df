"""Training-data operators: search, mixing, archives, quality rules, line and
near-duplicate removal, tokenization, licence scans, record files, URL filters.

Nothing else in the library imports this subpackage.
"""
