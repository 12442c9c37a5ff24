"""Fixed values of the catalogue schema: word lists and column lists."""

# Genre vocabulary.
GENRES = [
    "Action", "Adventure", "Casual", "Early Access", "Free to Play",
    "Indie", "Massively Multiplayer", "RPG", "Racing", "Simulation",
    "Sports", "Strategy", "Violent", "Sexual Content", "Gore",
]

# Category keywords behind each flag.
CATEGORY_GROUPS = {
    "has_singleplayer": ["Single-player"],
    "has_multiplayer": ["Multi-player", "Online PvP"],
    "has_coop": ["Co-op", "Online Co-op", "Local Co-Op", "Full Co-op",
                 "Shared/Split Screen Co-op"],
    "has_vr": ["VR Supported", "VR Only"],
    "has_controller": ["Full controller support", "Partial Controller Support",
                       "Tracked Controller Support"],
    "has_achievements": ["Steam Achievements"],
    "has_trading_cards": ["Steam Trading Cards"],
    "has_workshop": ["Steam Workshop"],
    "has_family_sharing": ["Family Sharing"],
    "has_cloud_saves": ["Steam Cloud"],
    "has_leaderboards": ["Steam Leaderboards"],
    "has_remote_play": ["Remote Play Together", "Remote Play on Phone",
                        "Remote Play on TV"],
}

# Ordinal scale of the publisher class.
CLASS_ORDER = {"Hobbyist": 0, "Indie": 1, "AA": 2, "AAA": 3}

# Columns with no predictive use.
DROPPED_COLUMNS = [
    "Movies", "Score rank", "Metacritic url", "Reviews", "Notes", "Website",
    "Support url", "Support email", "Header image", "steamUrl", "Screenshots",
    "User score", "unreleased", "Full audio languages",
]

# Columns seen only after the outcome.
POST_OUTCOME_COLUMNS = [
    "Positive", "Negative", "total_reviews", "review_ratio", "Recommendations",
    "Average playtime forever", "Average playtime two weeks",
    "Median playtime forever", "Median playtime two weeks", "Peak CCU",
    "reviewScore", "Metacritic score", "has_metacritic",
    "estimated_owners_midpoint",
]

# Skewed columns put on a log1p scale.
LOG1P_COLUMNS = [
    "Price", "Positive", "Negative", "total_reviews", "Recommendations",
    "Peak CCU", "Average playtime forever", "Average playtime two weeks",
    "Median playtime forever", "Median playtime two weeks", "DLC count",
    "Achievements", "estimated_owners_midpoint",
]

# Name prefixes of passthrough 0/1 features.
BINARY_PREFIXES = (
    "genre_", "category_", "has_", "tag_", "is_free", "earlyAccess",
    "required_age", "Windows", "Mac", "Linux",
)

# Edges of the price bands and of the error slices.
PRICE_EDGES = [0.0, 5.0, 20.0, 60.0, 1000.0]
TARGET_EDGES = [100.0, 1_000.0, 10_000.0, 100_000.0, 1_000_000.0]
TARGET_LABELS = ["<=100", "100-1k", "1k-10k", "10k-100k", "100k-1M", ">1M"]
AGE_EDGES = [0.0, 1.0, 3.0, 5.0, 10.0]
AGE_LABELS = ["0", "1", "2-3", "4-5", "6-10", ">10"]
LENGTH_LABELS = ["very_short", "short", "medium", "long", "very_long"]
