"""Run parameters and their validation."""

from __future__ import annotations

from dataclasses import dataclass

# Default thresholds and option names, needed for equal results.
DEFAULT_EPS_LIST = (
    0.01, 0.015, 0.02, 0.025, 0.03, 0.035, 0.04,
    0.045, 0.05, 0.055, 0.06, 0.065, 0.07,
)
SIM_METRICS = ("cosine", "l2")
SURVIVOR_RULES = ("hard", "easy", "random")

# Similarities are rounded to this many decimals before they are compared, so
# that copies tie exactly whatever block or machine computed the product.
SIM_DECIMALS = 12

# Broadcasts and driver-side model parameters are refused beyond this size.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# A window over one cluster is used up to this many rows; above it, ranking
# goes through a range sort.
MAX_WINDOW_ROWS = 2_000_000

# A vector with more copies than this is salted in joins on the vector.
HOT_COPIES = 100_000

# Rows of one block in the pairwise join. A row is sent once for each block of its
# cluster: fewer rows mean more shuffled, more rows more memory in a task (two blocks of
# vectors in double precision, twice: 32 MB at 64 values, 400 MB at 768).
BLOCK_ROWS = 16_384


def validate_metric(sim_metric: str, spherical: bool) -> None:
    if sim_metric not in SIM_METRICS:
        raise ValueError(f"sim_metric must be one of {SIM_METRICS}, got {sim_metric!r}")
    if spherical and sim_metric == "l2":
        raise ValueError("spherical k-means needs sim_metric='cosine'")


def validate_survivor_rule(which_to_keep: str) -> str:
    rule = which_to_keep.lower()
    if rule not in SURVIVOR_RULES:
        raise ValueError(f"which_to_keep must be one of {SURVIVOR_RULES}, got {which_to_keep!r}")
    return rule


def validate_eps(eps_list) -> list[float]:
    values = [float(e) for e in eps_list]
    if not values:
        raise ValueError("eps_list is empty")
    if len(set(values)) != len(values):
        raise ValueError(f"eps_list repeats a value: {values}")
    return values


def eps_name(eps: float) -> str:
    """Text form of a threshold, used in column and partition names."""
    return repr(float(eps))


@dataclass(frozen=True)
class PruneConfig:
    """Parameters of one pruning run.

    ``dataset_size`` is the denominator of the retained percentage; the corpus
    is counted when it is None. ``flags_only`` finds no similarity up to
    1 - max(eps_list), which leaves out the comparison of vectors far apart.
    ``coarse_clusters`` trains in two levels, for very many clusters.
    """

    num_clusters: int = 100
    niter: int = 150
    seed: int = 1234
    spherical: bool = True
    sim_metric: str = "cosine"
    keep_hard: bool = True
    which_to_keep: str = "hard"
    eps_list: tuple[float, ...] = DEFAULT_EPS_LIST
    save_eps_list: tuple[float, ...] = DEFAULT_EPS_LIST
    largest_cluster_size_to_process: int | None = None
    dataset_size: int | None = None
    block_rows: int = BLOCK_ROWS
    flags_only: bool = False
    coarse_clusters: int | None = None

    def __post_init__(self):
        validate_metric(self.sim_metric, self.spherical)
        validate_survivor_rule(self.which_to_keep)
        known = validate_eps(self.eps_list)
        missing = [e for e in validate_eps(self.save_eps_list) if e not in known]
        if missing:
            raise ValueError(f"save_eps_list has thresholds outside eps_list: {missing}")
        if self.num_clusters < 1 or self.niter < 1 or self.block_rows < 1:
            raise ValueError("num_clusters, niter and block_rows must be positive")
        coarse = self.coarse_clusters
        if coarse is not None and not 2 <= coarse <= self.num_clusters:
            raise ValueError("coarse_clusters must lie between 2 and num_clusters")
        limit = self.largest_cluster_size_to_process
        if limit is not None and limit < 1:
            raise ValueError("largest_cluster_size_to_process must be positive")
