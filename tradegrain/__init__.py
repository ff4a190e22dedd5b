"""Customer scorecards, governed metrics and data-quality pipelines as Spark jobs."""
