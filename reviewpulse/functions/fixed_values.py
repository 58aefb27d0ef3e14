"""Constants and word lists that results depend on. Change them and results change."""

SHORT_TEXT_LEN = 5
DUPLICATE_TEXT_MIN = 3
TINY_TEXT_LEN = 6
BUSY_HOUR_QUANTILE = 0.95
DEFAULT_TARGET_REVIEWS = 500

TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
URL_PATTERN = r"https?://\S+|www\.\S+"

LOW_INFORMATION_WORDS = ["ok", "good", "nice", "bad", "wow", "lol", "ads"]
POSITIVE_KEYWORDS = ["good", "great", "excellent", "love", "amazing", "perfect"]
NEGATIVE_KEYWORDS = ["bad", "terrible", "worst", "hate", "bug", "crash", "ads", "scam"]

STOP_WORDS = (
    "a an the and or but if in on at to for of as by with from is are was were be been being "
    "it its this that these those i you he she we they what which who whom my your his her "
    "our their me him us them do does did doing have has had having will would could should "
    "may might must not no yes so than then too very can just about into through over after "
    "before between under again further once here there when where why how all both each few "
    "more most other some such only own same s don doesn did wasn werent im ive id ill lets "
    "get got go going gone app apps one two also like even much way use used using make made "
    "out up down off back well really still ever every never because since while though "
    "although unless until"
).split()

LANGUAGE_NAMES = {
    "en": "English", "af": "Afrikaans", "ar": "Arabic", "bg": "Bulgarian", "bn": "Bengali",
    "ca": "Catalan", "cs": "Czech", "cy": "Welsh", "da": "Danish", "de": "German",
    "es": "Spanish", "et": "Estonian", "fa": "Persian (Farsi)", "fi": "Finnish", "fr": "French",
    "hi": "Hindi", "hr": "Croatian", "hu": "Hungarian", "id": "Indonesian", "it": "Italian",
    "kn": "Kannada", "ko": "Korean", "lt": "Lithuanian", "lv": "Latvian", "mk": "Macedonian",
    "mr": "Marathi", "ne": "Nepali", "nl": "Dutch", "no": "Norwegian", "pl": "Polish",
    "pt": "Portuguese", "ro": "Romanian", "ru": "Russian", "sk": "Slovak", "sl": "Slovenian",
    "so": "Somali", "sq": "Albanian", "sv": "Swedish", "sw": "Swahili", "ta": "Tamil",
    "te": "Telugu", "th": "Thai", "tl": "Tagalog", "tr": "Turkish", "uk": "Ukrainian",
    "ur": "Urdu", "vi": "Vietnamese", "zh-cn": "Chinese (Simplified)",
    "zh-tw": "Chinese (Traditional)", "unknown": "Unknown (undetected or too short)",
}
UNKNOWN_LANGUAGE = "unknown"
OTHER_LANGUAGES_LABEL = "Other (remaining languages)"
TOP_LANGUAGES = 15

# Monitoring defaults.
RAW_ROWS_MIN = 5000
APPS_COUNT_EXPECTED = 14
APPS_COUNT_MIN_DELTA = 2
DUPLICATE_RATE_MAX = 0.02
EMPTY_TEXT_RATE_MAX = 0.01
PARSEABLE_TIME_RATE_MIN = 0.99
PARSEABLE_SCORE_RATE_MIN = 0.99
ENGLISH_RATE_MIN = 0.50
CLEAN_EN_ROWS_MIN = 8000
MISSING_KEY_FIELDS_RATE_MAX = 0.005
SHORT_TEXT_RATE_WARN = 0.30
BASELINE_WINDOW = 5
PSI_RATING_MAX = 0.20
ZSCORE_LEN_MEAN_MAX = 3.0
DAILY_VOLUME_SPIKE_RATIO = 2.0
EN_SHARE_DROP_MAX = 0.10
PSI_FLOOR = 1e-6

# Warehouse subset labels, decided by what the source name contains.
SUBSET_EN = "clean_en_only"
SUBSET_ALL = "clean_all_languages"
SUBSET_OTHER = "custom"
STORED_COUNT_METRIC = "sqlite_reviews_count"
STORED_META_METRIC = "sqlite_ingestion_meta"
