"""Operators for preparing large text corpora (see README, "Corpus operators")."""
