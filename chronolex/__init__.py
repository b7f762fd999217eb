"""Corpus analytics and topic modelling on Spark DataFrames."""
