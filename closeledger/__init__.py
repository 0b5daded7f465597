"""closeledger: period-close general-ledger extracts as Spark DataFrame jobs.

Layers: ``functions`` (column expressions: period rule, labels, money),
``operators`` (segment rules, hierarchy joins, balances, watermark,
controls), ``plans`` (the named extracts and the runner), ``sources``
(schemas, readers, test-data derivation) and ``sinks`` (CSV contract, Parquet,
JDBC, publishing, audit).
"""

__version__ = "0.1.0"
