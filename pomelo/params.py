"""Run parameters and the fixed values results depend on.

Fixed values (must stay as written for results to match):
  item code prefix ............ "11"
  default top-K ............... 30000
  default decision threshold .. 0.5
  split fractions ............. 0.8 train / 0.2 validation
  split seed .................. 1234
  age buckets ................. 7-14 -> 1, 15-22 -> 2, 23-35 -> 3,
                                36-45 -> 4, 46-76 -> 5, otherwise 0
  kept age range .............. 7 to 76 inclusive
  encoded-id lengths .......... 14 chars -> year at [6,10);
                                12 chars -> 1900 + two digits at [6,8)
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
CODE_PREFIX = "11"
DEFAULT_TOP_K = 30000
DEFAULT_THRESHOLD = 0.5
SPLIT_FRACTIONS = (0.8, 0.2)
SPLIT_SEED = 1234
AGE_BUCKETS = ((7, 14, 1), (15, 22, 2), (23, 35, 3), (36, 45, 4), (46, 76, 5))
AGE_MIN, AGE_MAX = 7, 76
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ClassNames:
    """Attribute-neutral names for the two classes (label 1 / label 0)."""

    positive: str = "pos"
    negative: str = "neg"


@dataclass(frozen=True)
class RunParams:
    """Parameters of one daily run.  Dates are ``yyyyMMdd`` strings."""

    run_date: str = "20171028"
    top_k: int = DEFAULT_TOP_K
    code_prefix: str = CODE_PREFIX
    threshold: float = DEFAULT_THRESHOLD
    select_threshold: bool = True
    split_seed: int = SPLIT_SEED
    train_fraction: float = SPLIT_FRACTIONS[0]
    classes: ClassNames = field(default_factory=ClassNames)
    # dates used by the auxiliary jobs
    label_date: str = "20171028"
    agreement_date: str = "20170711"
    snapshot_new: str = "20171028"
    snapshot_old: str = "20170910"
    reference_year: int = 2017
    # buckets of the written feature table (by entity_id); the training job
    # joins and aggregates it on entity_id without shuffling it again
    feature_buckets: int = 256


# Parameters of the registered driver queries.  K is below the number of
# items at sf0.01 and sf0.1 so that the top-K cut really cuts.
QUERY_PARAMS = RunParams(top_k=1000)
