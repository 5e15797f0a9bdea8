"""Formats and constants that results depend on.

Nothing here is logic.  Each value is part of the dump format or of the catalog's
contract and must stay as it is for results to stay comparable.
"""

# Dump files and staged datasets carry this prefix.
DUMP_PREFIX = "ol_dump_"
DUMP_SUFFIX = ".txt"
FALLBACK_DATASET = "ol_dump"

# Kind of a dump file by a part of its lower-cased name; the first match wins.
KIND_COVERS = "covers"
KIND_WIKIDATA = "wikidata"
KIND_TSV = "tsv"
KIND_JSON = "json"
FILE_KIND_BY_NAME_PART = [
    ("covers_metadata", KIND_COVERS),
    ("wikidata", KIND_WIKIDATA),
    ("ratings", KIND_TSV),
    ("reading-log", KIND_TSV),
]

# Record type key -> entity kind, in tie-breaking order.
TYPE_TO_KIND = [
    ("/type/work", "work"),
    ("/type/edition", "edition"),
    ("/type/author", "author"),
]

# Entity kind -> (entity type in source links, title column, foreign key column).
KIND_CONFIG = {
    "work": ("book", "title", "book_id"),
    "edition": ("edition", "title", "edition_id"),
    "author": ("author", "name", "author_id"),
}

# Numeric part of a record key such as /works/OL12W.
NUMERIC_KEY_PATTERN = r"(?i)OL([0-9]+)[A-Z]\z"

# JSON keys that hold subjects, in reading order.
SUBJECT_KEYS = ["subjects", "subject_places", "subject_people", "subject_times", "genres"]

# Text limits, in characters.
MAX_LAST_MODIFIED = 64
TEXT_LIMITS = {"ol_key": 255, "last_modified": 64, "wd_id": 64, "source": 64, "source_key": 255}
INTRO_LENGTH = 500
MAX_SLUG_BASE = 220
MAX_TSV_COLUMNS = 200
FIRST_LINE_BYTES = 4096

UNKNOWN_SOURCE = "unknown"
STATUS_ACTIVE = 1
DEFAULT_LOCALE = "en"
NULL_MARKER = "\\N"

# Latin spelling of Cyrillic letters in slugs.
CYRILLIC_TO_LATIN = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e",
    "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m",
    "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
    "і": "i", "ї": "yi", "є": "ie", "ґ": "g",
}
