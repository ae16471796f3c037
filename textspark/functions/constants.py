"""Fixed values that must equal the behaviour being reproduced.

Kept together, in natural order, as plain text.
"""

# --- fixed values: special tokens (ids 0..3 in word and BPE vocabularies) ---
PAD_TOKEN = "<pad>"
UNK_TOKEN = "<unk>"
BOS_TOKEN = "<bos>"
EOS_TOKEN = "<eos>"
SPECIAL_TOKENS = [PAD_TOKEN, UNK_TOKEN, BOS_TOKEN, EOS_TOKEN]

# --- fixed values: dialogue layout ---
CHAT_USER_PREFIX = "User:"
CHAT_BOT_PREFIX = "Bot:"
TURN_SEPARATOR = "__eou__"

# --- fixed values: character replacements applied before cleaning ---
# right single quote, left single quote, prime -> apostrophe;
# left/right double quotes -> straight double quote;
# em dash, en dash -> hyphen; ideographic full stop -> "."; ideographic comma -> ","
CHAR_REPLACEMENTS = [
    ("’", "'"), ("‘", "'"), ("′", "'"),
    ("“", '"'), ("”", '"'),
    ("—", "-"), ("–", "-"),
    ("。", "."), ("、", ","),
]

# --- fixed values: word decoder glues these tokens to the previous one ---
NO_SPACE_BEFORE = [".", ",", "!", "?", ";", ":", "'", ")", "]", "}", '"']

# --- fixed values: defaults ---
NUM_MERGES = 4000
SWEEP_MERGES = [500, 2000, 4000, 8000]
CONTEXT_LENGTH = 128
STRIDE = CONTEXT_LENGTH // 2
BATCH_SIZE = 32
VAL_RATIO = 0.1
EVAL_EVERY = 100
MAX_NEW_TOKENS = 100
TEMPERATURE = 0.8
TOP_K = 40

# --- fixed values: request limits and messages ---
MAX_NEW_TOKENS_LIMIT = 500
MAX_PROMPT_CHARS = 2000
TEMPERATURE_RANGE = (0.0, 2.0)
TOP_K_RANGE = (0, 100_000)
SEED_RANGE = (0, 2**32 - 1)
MSG_NOT_OBJECT = "Request body must be a JSON object."
MSG_EMPTY_PROMPT = "Type a prompt first."
MSG_LONG_PROMPT = "Prompt is too long (max 2000 characters)."
MSG_CHAT_BOOL = "chat must be true or false."
MSG_EMPTY_TOKENS = "Prompt produced no tokens -- use a non-empty prompt."
STOP_WORDS = ["quit", "exit"]

# --- fixed values: parity tolerance for score comparisons ---
PARITY_TOLERANCE = 1e-3
