"""lexiloom: a Spark-first engine for integrating, linking and searching overlapping record sources."""
