"""Readers of vectors, ids, corpora and saved stage outputs."""

from neardup.sources.corpus import IndexedCorpus, index_corpus, open_corpus, read_corpus
from neardup.sources.tables import (
    read_assignment,
    read_centroids,
    read_kept,
    read_prior,
    read_sorted_clusters,
)
from neardup.sources.vectors import (
    numbered_ids,
    read_fixed_width_ids,
    read_raw_vectors,
    read_vectors,
)

__all__ = [
    "IndexedCorpus",
    "index_corpus",
    "numbered_ids",
    "open_corpus",
    "read_assignment",
    "read_centroids",
    "read_corpus",
    "read_fixed_width_ids",
    "read_kept",
    "read_prior",
    "read_raw_vectors",
    "read_sorted_clusters",
    "read_vectors",
]
