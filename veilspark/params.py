"""Privacy parameters and the fixed values the release must agree on."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

# Fixed values (defaults of the example application; they decide the results)
DEFAULT_EPSILON = 10.0
DEFAULT_DELTA = 1e-5
DEFAULT_HORIZON = 60            # number of releases T the noise tree supports
DEFAULT_MAX_CONTRIBUTIONS = 50  # C, contributions kept per user over the whole run
DEFAULT_PER_RECORD_CLAMP = 1.0  # L_m, bound on a single contribution
DEFAULT_REPLAY_WINDOW = 128     # sequence numbers tracked per producer
DEFAULT_PERCENTILE = 0.99       # percentile used to suggest C


@dataclass(frozen=True)
class PrivacyParams:
    """(epsilon, delta) budget, horizon T, contribution bound C, clamp L_m.

    ``user_level`` switches between user-level privacy (bound each user to C
    contributions) and event-level privacy (no bounding).
    """

    epsilon: float = DEFAULT_EPSILON
    delta: float = DEFAULT_DELTA
    horizon: int = DEFAULT_HORIZON
    max_contributions: int = DEFAULT_MAX_CONTRIBUTIONS
    per_record_clamp: float = DEFAULT_PER_RECORD_CLAMP
    user_level: bool = True

    def __post_init__(self):
        if self.epsilon < 0:
            raise ValueError("epsilon must be non-negative")
        if not self.delta > 0:
            raise ValueError("delta must be positive")
        if self.horizon < 1:
            raise ValueError("horizon must be at least 1")
        if self.max_contributions < 1:
            raise ValueError("max_contributions must be at least 1")
        if self.per_record_clamp <= 0:
            raise ValueError("per_record_clamp must be positive")

    @property
    def l1_sensitivity(self) -> float:
        return self.max_contributions * self.per_record_clamp

    @property
    def tree_height(self) -> int:
        """H = ceil(log2 T), computed as the natural-log ratio on purpose."""
        return int(math.ceil(math.log(self.horizon) / math.log(2)))

    @property
    def num_leaves(self) -> int:
        return 2 ** self.tree_height

    @property
    def rho(self) -> float:
        from veilspark.operators.calibration import cdp_rho

        return cdp_rho(self.epsilon, self.delta)

    @property
    def sigma(self) -> float:
        from veilspark.operators.calibration import tree_sigma

        return tree_sigma(self.rho, self.horizon, self.l1_sensitivity)

    def with_(self, **kw) -> "PrivacyParams":
        return replace(self, **kw)
