"""Whole runs composed from the operators."""

from neardup.plans.prune import prune_corpus, prune_vectors

__all__ = ["prune_corpus", "prune_vectors"]
