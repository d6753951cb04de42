"""Fixed values that must equal the behaviour being rebuilt.

Everything here is a plain default; every job takes these as parameters so
that a user can pass other lists.
"""

# --- fixed values: caption keyword list (case-insensitive substring test) ---
CAPTION_KEYWORDS = (
    "korting",
    "discount",
    "% off",
    "%off",
    "% of",
    "%of",
    "my code",
    "mijn code",
    "de code",
    "code:",
    "code",
    "save",
    "bespaar",
    "besparen",
    "with code",
    "met code",
    "use code",
    "gebruik code",
    "coupon",
    "werbung",
    "anzeige",
    "rabatt",
    "dem code",
    "le code",
    "remise",
    "réduction",
    "reduction",
    "spart",
)

# --- fixed values: publication filter rules ---
RECENT_REPOST_WEEKS = 3
DEFAULT_DISCOUNT_VALUE = "10"
BRAND_DEFAULT_DISCOUNT_VALUES = {"shein": "15"}
PERCENT_REVIEW_THRESHOLD = 40
EURO_REVIEW_THRESHOLD = 100
REVIEW_PREFIX = "REVIEW_"
REVIEW_HIGH = "REVIEW_HIGH__"
MULTI_TAG = "MULTI__"
IGNORED_BRANDS = ("hellofresh.nl", "aybl", "esn", "gymshark", "achateshop.com")
BRAND_MIN_CODE_LENGTH = {"shein": 6}
# Limits of the training history; none by default (callers may pass some).
ARCHIVE_BATCH_LIMIT = None
MIN_TRAINING_BATCH_SIZE = 0
BOOSTED_BRANDS = (
    "temu",
    "bylashbabe",
    "idealofsweden",
    "vitakruid",
    "desenio",
    "myproteinnl",
    "smartphonehoesjes.nl",
    "hellofresh.nl",
    "rosental-organics.nl",
)
BOOSTED_BASE_SCORE = 4.0

# --- fixed values: log markers and line patterns ---
PRINTING_RESULTS_MARKER = "**PRINTING RESULTS**"
PIPELINE_END_MARKER = "**FINISHED MAIN PIPELINE**"
PRINTED_SUMMARY_PATTERN = r"^Printed \d+ unique discount records\.\s*$"
PREV_SEEN_DATE_PATTERN = r"\.{10}(\d{2})-(\d{2})"
QUOTED_FIELDS_PATTERN = r'"([^"]*)"'
DISCOUNT_VALUE_PATTERN = r"^€?(\d+(?:\.\d+)?)%?$"
# Emoji code point ranges removed from published lines.
EMOJI_PATTERN = r"[\x{1F000}-\x{1FFFF}\x{2600}-\x{27BF}\x{FE00}-\x{FE0F}\x{200D}]+"
# Keys in a TypeScript object literal: quoted text followed by a colon.
SOURCE_KEY_PATTERN = r"""["']([^"']+)["']\s*:"""

# --- fixed values: influencer discovery ---
DISCOVERY_BRANDS = (
    "gutsgusto",
    "loavies",
    "getdrezzed",
    "begoldennl",
    "mimamsterdam",
    "paulie__pocket",
    "famousstore",
    "terstalnl",
    "maniacnails.official",
    "tessvfashion",
)
DISCOVERY_MIN_BRANDS = 1
DISCOVERY_MAX_TOTAL = 1345
PROFILE_URL_PREFIX = "https://www.instagram.com/"

# --- fixed values: platforms ---
PLATFORMS = ("instagram", "tiktok")
TIKTOK_SUFFIX = "_tiktok"
# Characters of a caption that count for the post key; None: all of them.
KEY_PREFIX_CHARS = None
