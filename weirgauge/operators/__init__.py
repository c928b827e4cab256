"""Data-quality operators over DataFrames; see the README for the inventory."""
