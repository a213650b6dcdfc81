"""Trip analytics on Spark: raw CSV -> bronze -> silver -> gold marts, with BI queries,
data-quality checks, run ledgers, month-window planning and table maintenance."""
