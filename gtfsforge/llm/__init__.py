"""Training-data operators: joins, searches, tokenising, filtering and mixing of text corpora on Spark."""
