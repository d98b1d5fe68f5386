"""Operators for training corpora: cleaning, matching, mixing, searching, tokenising, scoring."""
