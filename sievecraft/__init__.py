"""sievecraft: corpus curation as Spark DataFrame jobs."""
