"""The registered query catalogue (imports every catalogue module for its side effect)."""

from tabreg.plans import (q_clean, q_evaluate, q_features, q_missing, q_models, q_profile,  # noqa: F401
                          q_relate, q_split)
from tabreg.plans.registry import REGISTRY  # noqa: F401
