"""Whole flows: load, split, plant noise, score, rank, prune, refit, compare."""
