"""DataFrame -> DataFrame operators: cleaning, rankings, summaries, search, recommender, metrics."""
