"""Market-data tables, selections, links and candles as Spark DataFrame operators."""
