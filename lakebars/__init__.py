"""lakebars: a daily market-data lakehouse built from Spark DataFrame operators.

Layers (see README): raw pages and snapshots -> daily OHLCV bars (silver) ->
operational upsert, data-quality gate, SCD2 dimension and as-of mart (gold) ->
date-partitioned serving table.
"""

__version__ = "0.1.0"
