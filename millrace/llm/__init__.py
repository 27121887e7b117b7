"""Training-data operators: dedup, filters, language ID, sharding, mixing, search, decontamination.

Nothing outside this subpackage imports it. Every operator takes DataFrames, reads
only the columns it is told to, and leaves its result lazy where it can.
"""
