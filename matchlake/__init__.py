"""matchlake: a PySpark-native engine for two-sided match logs.

Landed JSON / CSV / Parquet -> typed landing tables (insert-or-ignore, upsert)
-> star schema (battle facts; player, clan, card, deck and date dimensions)
-> data-quality rules -> dashboard reports.  Every operator is a DataFrame
function planned by Catalyst; nothing is collected to the driver.
"""

__version__ = "0.1.0"
