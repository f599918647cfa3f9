from playpulse.functions.privacy import (
    player_key,
    pseudonymize_player_id,
    suppress_small_groups,
)
from playpulse.functions.rules import (
    PROGRESSION_STATUSES,
    SUPPORTED_CATEGORIES,
    is_supported_category,
    is_valid_progression_status,
    normalize_category,
    percent,
    safe_rate,
)

__all__ = [
    "PROGRESSION_STATUSES",
    "SUPPORTED_CATEGORIES",
    "is_supported_category",
    "is_valid_progression_status",
    "normalize_category",
    "percent",
    "player_key",
    "pseudonymize_player_id",
    "safe_rate",
    "suppress_small_groups",
]
