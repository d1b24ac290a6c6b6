"""Whole plans: the corpus-to-clusters chain, the command-line programs, the checked queries."""
