"""Market-event analytics on Spark."""
