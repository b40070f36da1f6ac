"""Training-data operators: URL filters, de-duplication, scoring, packing, encoding, fingerprints, PII.

Nothing outside this subpackage imports it; removing the folder leaves the rest of the library whole.
"""
