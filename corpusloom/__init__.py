"""Corpus analytics on Spark: languages, vocabulary, TF-IDF, clusters, reports."""
