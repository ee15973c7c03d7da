"""Fixed values and defaults.

FIXED VALUES — these must equal the behaviour being reproduced; they are
stated here once, in natural order, and imported everywhere else.
"""

# --- fixed values: ingest ---------------------------------------------------
MAX_CHARS = 6000            # code points per episode slice

# --- fixed values: recall ---------------------------------------------------
CHARS_PER_TOKEN = 4         # est_tokens = max(1, len // 4)
RECALL_BUDGET = 800         # tokens
RECALL_OVER_FETCH = 25      # facts fetched before trimming

# --- fixed values: evaluation ------------------------------------------------
EVAL_MAX_FACTS = 10

# --- fixed values: maintenance reports ---------------------------------------
CONTRADICTIONS_LIMIT = 25
ACTIVITY_LOG_LINES = 2000

# --- fixed values: access log -------------------------------------------------
# port -> tier; anything else (or no port) is "?"
TIER_PORTS = {"8000": "personal", "8001": "client"}
UNKNOWN = "?"

# --- tiers (our names) ---------------------------------------------------------
# default group of a tier = the tier's own graph name
DEFAULT_GROUP = {"personal": "personal", "client": "client"}

# --- retrieval choices (published defaults) ------------------------------------
BM25_K1 = 1.2
BM25_B = 0.75
RRF_K = 60
SCORE_DIGITS = 9            # scores are rounded before ranking; ties by id
