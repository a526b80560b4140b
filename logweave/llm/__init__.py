"""Training-data operators: language ID, WARC archive, PII, decontamination, HTML extraction, dedup and mixing.

Nothing else in the library imports this subpackage.  Operators take and return
DataFrames; ``queries.py`` wires them to the test tables.
"""
