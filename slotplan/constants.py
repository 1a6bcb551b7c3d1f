"""Fixed values and defaults.

FIXED VALUES: these must equal the values the planner family has always used,
otherwise results differ. They are listed plainly and in their natural order.
"""

# FIXED VALUES — return-time slots in minutes (15 slots).
RETURN_SLOTS = (1, 5, 10, 15, 30, 45, 60, 120, 180, 360, 540, 720, 1440, 2160, 2880)
# FIXED VALUES — the combined tier report uses the same slots without the 1-minute one.
RETURN_SLOTS_TIERS = (5, 10, 15, 30, 45, 60, 120, 180, 360, 540, 720, 1440, 2160, 2880)

# FIXED VALUES — known time corrections (recipe name -> corrected time text).
TIME_FIXES = (
    ("Turtle Soup", "0.25 hrs"),
    ("Salmon Nigiri", "0.50 hrs"),
    ("Gilded Champagne", "1.00 hrs"),
    ("Midnight Martini", "3.00 hrs"),
    ("Golden Hour Cocktail", "8.00 hrs"),
    ("Silver Star Cupcakes", "8.00 hrs"),
)

# FIXED VALUES — master table leading columns, in this order.
PRIORITY_COLUMNS = (
    "game_mode",
    "rcp_name",
    "appl_name",
    "rcp_level",
    "rcp_time_min",
    "rcp_xp",
    "rcp_profit",
    "rcp_difficulty",
    "min_to_lvl99",
    "time_to_lvl99",
)

# FIXED VALUES — game modes in table order, tiers in report order.
MODES = ("restaurant", "bakery")
TIERS = ("easy", "medium", "hard")
# FIXED VALUES — difficulty ceiling per tier (easy means exactly 2).
TIER_MAX_SCORE = (("easy", 2), ("medium", 3), ("hard", 6))
# FIXED VALUES — appliance labels that make an appliance "medium" when alone.
MEDIUM_APPL_TOKENS = ("build", "gem")
# FIXED VALUES — label texts that count as empty.
EMPTY_LABELS = ("", "nan")

# FIXED VALUES — level-up fold: target xp and the slots a player starts with.
TARGET_XP = 803600
START_SLOTS = 2
# FIXED VALUES — columns the level table must carry.
LEVEL_TABLE_HEADERS = ("level", "xp", "slots", "expansion")

# Planner defaults (sheet defaults): mode, level, tier.
DEFAULT_MODE = "restaurant"
DEFAULT_LEVEL = 99
DEFAULT_TIER = "hard"
LEVEL_MIN, LEVEL_MAX = 1, 99

# Export chunk size (rows per chunk) for chunked publishing.
EXPORT_CHUNK_ROWS = 1000
