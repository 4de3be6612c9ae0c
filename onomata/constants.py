"""Fixed values that results depend on.

Fixed values: these must stay exactly as written for reports and type
handling to agree with the behaviour being reproduced.
"""

# The six entity types, in report order.
ENTITY_TYPES = (
    "Person",
    "Organization",
    "University",
    "Place",
    "Technology",
    "ProgrammingLanguage",
)

# Parent of each type (University is an Organization,
# ProgrammingLanguage is a Technology). Counting never rolls up to parents.
PARENT_TYPE = {
    "Person": None,
    "Organization": None,
    "University": "Organization",
    "Place": None,
    "Technology": None,
    "ProgrammingLanguage": "Technology",
}

# Type used when a dictionary file names an unknown type.
FALLBACK_TYPE = "Person"

# Label of the grand-total row in the type statistics.
TOTAL_LABEL = "total"

# Dictionary file name -> entity type, in load order.
DICTIONARY_FILES = (
    ("people.txt", "Person"),
    ("universities.txt", "University"),
    ("languages.txt", "ProgrammingLanguage"),
    ("organizations.txt", "Organization"),
    ("places.txt", "Place"),
)

# Report banners and labels (Spanish, as printed).
BANNER_PROCESSING = "============ ESTADÍSTICAS DE PROCESAMIENTO ============"
BANNER_TYPES = "============ ESTADÍSTICAS DE ENTIDADES ============"
BANNER_ENTITIES = "============ ENTIDADES NOMBRADAS MÁS FRECUENTES ============"
LABEL_FEEDS_OK = "Feeds descargados exitosamente"
LABEL_FEEDS_FAILED = "Feeds fallidos"
LABEL_POSTS_OK = "Posts descargados exitosamente"
LABEL_POSTS_FAILED = "Posts fallidos"
LABEL_POSTS_FILTERED = "Posts filtrados (vacíos/nulos)"
LABEL_AVG_CHARS = "Largo promedio en posts"
LABEL_TOTAL_ENTITIES = "Entidades totales"
LABEL_BY_CATEGORY = "Entidades por categoría:"
ENTITY_LINE_FORMAT = "[Type=%s] %s: %d apariciones"
TYPE_LINE_FORMAT = "    [%s]: %d"

# Diagnostic messages.
MSG_SKIPPED_SUBSCRIPTION = "Skipping malformed subscription (missing 'name' or 'url' field)"
MSG_INVALID_JSON = "Could not load subscriptions - invalid JSON format"
MSG_FILE_NOT_FOUND = "Could not load %s - file not found"
MSG_FETCH_FAILED = "Failed to download from '%s' (%s)"
MSG_PARSE_FAILED = "Failed to parse posts from '%s' (%s)"
MSG_DICT_MISSING = "Could not load %s"
MSG_NO_SUBSCRIPTIONS = "No valid subscriptions found"
MSG_NO_POSTS = "No valid posts downloaded after filtering"

# Feed outcome codes, in the order they are tested.
FEED_STATUSES = (
    "SKIPPED",
    "FETCH_FAILED",
    "BAD_JSON",
    "NO_CHILDREN",
    "MISSING_FIELD",
    "BAD_FIELD",
    "EMPTY",
    "OK",
)

DEFAULT_TOP_K = 10
