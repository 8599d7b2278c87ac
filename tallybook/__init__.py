"""tallybook: ledger analytics, integrity checks and clean-ups on Spark.

Sub-packages:
    sources    -- typed table schemas, fixture derivation, CSV export/import jobs
    functions  -- Column expressions with PostgreSQL semantics
    operators  -- relational operators, joins, id allocation, checks, mutations
    plans      -- ledger reports, integrity roll-ups, the query registry
    streaming  -- (empty by design; the ledger has no streams)
"""

__version__ = "0.1.0"
