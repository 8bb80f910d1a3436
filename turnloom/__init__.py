"""turnloom: DataFrame operators for chat corpora (extract, clean, pair, render, evaluate)."""
