"""Readers and writers: topics, recorded changes, listings, articles, stopwords."""
