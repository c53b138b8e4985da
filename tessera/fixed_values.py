"""Fixed values.

Everything in this module must equal the values of the corpus tooling this
library re-implements, because outputs (category names, language labels,
token filters, chunk boundaries, admission rules) depend on them.  They are
stated plainly and in their natural order.
"""

# --- fixed values: thesaurus root categories (letter -> name) ---------------
ROOT_CATEGORIES = [
    ("A", "Anatomy"),
    ("B", "Organisms"),
    ("C", "Diseases"),
    ("D", "Chemicals and Drugs"),
    ("E", "Analytical, Diagnostic and Therapeutic Techniques and Equipment"),
    ("F", "Psychiatry and Psychology"),
    ("G", "Phenomena and Processes"),
    ("H", "Disciplines and Occupations"),
    ("I", "Anthropology, Education, Sociology and Social Phenomena"),
    ("J", "Technology, Industry, Agriculture"),
    ("K", "Humanities"),
    ("L", "Information Science"),
    ("M", "Named Groups"),
    ("N", "Health Care"),
    ("V", "Publication Characteristics"),
    ("Z", "Geographicals"),
]

# --- fixed values: abstract language indicator substrings --------------------
SPANISH_INDICATORS = [
    "objetivo", "métodos", "resultados", "conclusión", "conclusiones",
    "introducción", "material", "pacientes", "estudio", "análisis",
]
ENGLISH_INDICATORS = [
    "objective", "methods", "results", "conclusion", "conclusions",
    "introduction", "material", "patients", "study", "analysis",
]

# --- fixed values: white space, word letters, URL and e-mail patterns ---------
# (the inside of a character class: what str.split() and str.strip() remove)
WHITESPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
HAS_LETTER = r"[a-zA-ZáéíóúüñÁÉÍÓÚÜÑ]"
URL_PATTERN = rf"http[^{WHITESPACE}]+|www[^{WHITESPACE}]+|https[^{WHITESPACE}]+"
EMAIL_PATTERN = rf"[^{WHITESPACE}]+@[^{WHITESPACE}]+"

# --- fixed values: language labels -------------------------------------------
LANG_SPANISH = "spanish"
LANG_ENGLISH = "english"
LANG_MIXED = "mixed_or_unknown"
LANG_UNKNOWN = "unknown"

# --- fixed values: extra academic stopwords added to the Spanish list --------
EXTRA_SPANISH_STOPWORDS = [
    "además", "asimismo", "así", "embargo", "tanto", "través", "debido",
    "respecto", "relación", "partir", "acuerdo", "dentro", "fuera",
]

# --- fixed values: quality thresholds ----------------------------------------
MIN_ABSTRACT_WORDS = 50
MIN_LANGUAGE_HITS = 2

# --- fixed values: natural cut tokens for document chunking ------------------
CUT_TOKENS = [".", ",", ";", "!", "?"]
CHUNK_LOOKAHEAD = 50

# --- fixed values: BIO validation error types and fixes ----------------------
ERR_INVALID_FORMAT = "INVALID_LABEL_FORMAT"
ERR_ORPHAN_I = "ORPHAN_I_TAG"
ERR_TYPE_MISMATCH = "ENTITY_TYPE_MISMATCH"
ERR_EMPTY_TYPE = "EMPTY_ENTITY_TYPE"

# --- fixed values: file admission ---------------------------------------------
SYSTEM_FILE_NAMES = [".DS_Store", "Thumbs.db", "desktop.ini"]
APPLEDOUBLE_TEXT_MARK = b"Mac OS X"
APPLEDOUBLE_MAGIC = b"\x00\x05\x16\x07"
TOKEN_FILE_SUFFIX = ".nersuite"

# --- fixed values: batch request envelope -------------------------------------
REQUEST_METHOD = "POST"
REQUEST_URL = "/v1/chat/completions"
CHUNK_ID_SEPARATOR = "__chunk_"

# --- fixed values: random split -----------------------------------------------
SPLIT_SEED = 42
TEST_FRACTION = 0.2
VAL_FRACTION = 0.2
