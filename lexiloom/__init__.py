"""Corpus statistics on Spark: collocations, annotation tasks, dependency-path similarity."""
