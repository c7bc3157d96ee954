"""flowmart: market-flow analytics as plain PySpark DataFrame programs."""
