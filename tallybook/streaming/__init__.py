"""No streaming operators.

The ledger is a set of fixed-schema batch tables: there is no stream, window,
watermark or stateful operator to reproduce, so this package is empty on
purpose.  Incremental loads are batch appends (``sources.io.load_mode`` without
truncation) followed by the same checks.
"""
