"""Analytics over structured text corpora, planned by Spark."""
