"""Fixed values.

These must equal the established ones for results to agree: markers, patterns,
labels and thresholds. They are plain text in their natural order. Word lists
and keyword dictionaries are not here: they are inputs, read from the user's
own files (see ``murmur.sources.dictionaries``).
"""

# --- Text that stands for "no language detected" after translation.
NO_LANGUAGE = "Error: no language detected!"

# --- Spam rules.
MAX_CHARS = 1000
MIN_TOPIC_MENTIONS = 2
TOPIC = r"[Ff]irefox|browser"
MAX_DIGIT_RUNS = 30

# --- Character classes, spelled so that Spark's regex engine agrees with
#     Unicode-aware \w, \s and \d.
WORD_CHARS = r"\p{L}\p{N}_"
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
DIGIT = r"\p{Nd}"
WORD = rf"[{WORD_CHARS}]+"
WORD_OF_TWO = rf"[{WORD_CHARS}]{{2,}}"

# --- Personal data.
_GAP = r"[\-.\s\x0B\x1C-\x1F\x85\p{Z}]??"
EMAIL = rf"[{WORD_CHARS}.\-]+@[{WORD_CHARS}.\-]+"
PHONE = (
    rf"{DIGIT}{{3}}{_GAP}{DIGIT}{{3}}{_GAP}{DIGIT}{{4}}"
    rf"|\({DIGIT}{{3}}\){SPACE}*{DIGIT}{{3}}{_GAP}{DIGIT}{{4}}"
    rf"|{DIGIT}{{3}}{_GAP}{DIGIT}{{4}}"
)

# --- The same patterns in Python's notation, against which the tests hold Spark's.
PYTHON_EMAIL = r"[\w\.-]+@[\w\.-]+"
PYTHON_PHONE = r"(\d{3}[-\.\s]??\d{3}[-\.\s]??\d{4}|\(\d{3}\)\s*\d{3}[-\.\s]??\d{4}|\d{3}[-\.\s]??\d{4})"
PYTHON_SENTENCE_END = r"(?<!\w\.\w.)(?<![A-Z][a-z]\.)(?<=\.|\?)\s"

# --- A blank after . or ? ends a sentence, except after "a.b." or "Mr.".
SENTENCE_END = (
    rf"(?<![{WORD_CHARS}]\.[{WORD_CHARS}].)(?<![A-Z][a-z]\.)(?<=\.|\?){SPACE}"
)

# --- Devices, in the order they are tried; the last one found wins.
DEVICES = ["iPhone", "iPad", "Windows", "Macintosh", "Linux"]
DEVICE_STORE = {
    "iPhone": "iOS",
    "iPad": "iOS",
    "Windows": "Desktop",
    "Macintosh": "Desktop",
    "Linux": "Desktop",
}
UNKNOWN_DEVICE = "Unknown"
VERSION_MARKERS = ["FxiOS/", "Firefox/"]

# --- Source layouts: our column -> source column ("" = absent, list = concatenated).
SURVEY = "SurveyGizmo"
STORE_REVIEWS = "Appbot"
SOURCE_COLUMNS = {
    SURVEY: {
        "date": "Date Submitted",
        "version": "Extended User Agent",
        "device": "Extended User Agent",
        "rating": "",
        "original": [
            "To help us understand your input, we need more information. Please describe what you like. The content of your feedback will be public, so please be sure not to include personal information such as email address, passwords or phone number.",
            "To help us understand your input, we need more information. Please describe your problem below and be as specific as you can. The content of your feedback will be public, so please be sure not to include personal information such as email address, passwords or phone number.",
        ],
        "country": "Country",
    },
    STORE_REVIEWS: {
        "date": "Date",
        "version": "Version",
        "store": "Store",
        "device": "",
        "rating": "Rating",
        "original": ["Subject", "Body"],
        "country": "Country",
    },
}
COUNTRY_NAMES = {"USA": "United States"}

# --- Sentiment bands.
MIN_MAGNITUDE = 0.25
MIN_SCORE = 0.15

# --- Tagging.
GENERIC_COMPONENT = "Firefox Browser"
OTHER_COMPONENT = "Others"
OTHER_FEATURE = "Other"
BUG_ISSUE = "Bug"
BUG_KEYWORD = "bug"
CONNECTORS = [" ", "-", "_", ""]
NEGATIONS = [
    "doesn’t", "doesnot", "does not", "didn't", "did not", "don't", "donot", "do not",
    "can't", "cannot", "can not", "couldn't", "couldnot", "could not", "will not", "won't",
    "wouldn't", "would not", "wouldnot", "isn't", "is not", "aren't", "wasn't", "weren't",
]
MAX_SYNONYMS = 3

# --- Similarity, clusters and summaries.
CLUSTER_SIMILARITY = 0.3
CLUSTER_SIZE = 4
MERGE_MIN_COUNT = 4
MAX_SUMMARY_CHARS = 80
UNKNOWN_SUMMARY = "Unknown"

# --- Persisted tables.
MAX_STORED_CHARS = 4000
CLEAR_FILTERS = "Clear Filters"
FIRST_DATE = "1999-01-01"
BATCH_DIGITS = 6
