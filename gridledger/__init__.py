"""Contract margins and volume forecasts as PySpark DataFrame jobs."""
