"""seriesmill: market time-series analytics as Spark DataFrame programs."""
