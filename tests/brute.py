"""Reference results by full similarity matrices in NumPy."""

import numpy as np


def prior(vectors, order, cluster):
    """``{row: (max_sim, mate row or None)}`` with ``order`` ascending inside clusters."""
    out = {}
    for c in set(cluster):
        rows = sorted((i for i in range(len(cluster)) if cluster[i] == c), key=lambda i: order[i])
        v = np.array([vectors[i] for i in rows], dtype=np.float64)
        s = np.round(np.triu(v @ v.T, 1), 12)
        np.fill_diagonal(s, 0.0)
        for j, row in enumerate(rows):
            top = s[:j, j].max() if j else 0.0
            if top <= 0:
                out[row] = (0.0, None)
            else:
                out[row] = (top, rows[int(np.argmax(s[:j, j]))])
    return out


def zero_diagonal(vectors):
    v = np.asarray(vectors, dtype=np.float64)
    s = v @ v.T
    np.fill_diagonal(s, 0.0)
    return s
