"""Corpus-scale phishing-risk analytics on Spark DataFrames."""
