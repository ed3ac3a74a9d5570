"""Market-margin analytics on Spark: DataFrame-to-DataFrame operators and the plans built on them."""
