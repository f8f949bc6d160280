"""Click-stream statistics on Spark: normalise, enrich, de-duplicate, count."""
