"""Fixed values.

Everything here must equal the published behaviour for results to agree: word
lists, character sets, thresholds, token names, category names. They are stated
once and used everywhere else by name.
"""

# --- character classes (as used inside [...]) --------------------------------
# Python's str.isspace(): Unicode White_Space plus U+001C..U+001F.
SPACE_CLASS = (
    r"\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set spelled out, for trim().
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Python's \w: letters, all number categories, underscore.
WORD_CLASS = r"\p{L}\p{N}_"
# Python's \d.
DIGIT_CLASS = r"\p{Nd}"

# --- line breaks recognised when a document is split into lines --------------
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# --- normalisation -----------------------------------------------------------
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"
NO_BREAK_SPACE = "\xa0"
CONTROL_CHARS = (
    "".join(chr(c) for c in range(0x00, 0x09))
    + "\x0b\x0c"
    + "".join(chr(c) for c in range(0x0E, 0x20))
    + "\x7f"
)

# --- code keywords ("#include" needs a word character before it) -------------
CODE_KEYWORDS = [
    "function", "var", "let", "const", "class", "return", "import", "export",
    "enum", "extends", "implements", "namespace", "public", "private",
    "protected", "static", "void", "try", "catch", "finally", "throw", "new",
    "#include", "template", "typename", "struct", "typedef", "using", "switch",
    "case", "break", "continue", "async", "await", "yield", "lambda", "fn",
    "match", "crate", "pub", "impl", "trait",
]
VISIBILITY_WORDS = ["public", "private", "protected"]
FENCE_MARKERS = ["```", "<code>", "</code>", "<pre>", "</pre>"]

# --- thresholds --------------------------------------------------------------
CODE_HEAVY_ABOVE = 0.40
MIN_CHARS = 200
MAX_CHARS = 50_000
SHORT_BELOW = 100
LONG_MEDIAN_ABOVE = 300
LONG_MEAN_ABOVE = 600
VERY_LONG_ABOVE = 20_000
SHORT_PERCENT_BELOW = 10
SIMHASH_CHUNK = 8
HAMMING_THRESHOLD = 3
BLOCK_SIZE = 2048
SHARD_SIZE = 50_000
SPLIT_RATIOS = (0.98, 0.01, 0.01)
BASE_VOCAB_SIZE = 50_257
# All base ids but the 256 bytes and the end of text.
BASE_MERGES = BASE_VOCAB_SIZE - 257

# --- names -------------------------------------------------------------------
TARGET_LANG = "EN"
UNKNOWN_LANG = "UNKNOWN"
PII_LABELS = ["email", "phone", "credit_card"]
VERDICTS = [
    "MALFORMED", "EMPTY", "NON_ENGLISH", "CODE_HEAVY", "TOO_SHORT", "TOO_LONG",
    "KEPT",
]
HTML_COUNTER = "HTML_STRIPPED"
END_OF_TEXT = "<|endoftext|>"
SPECIAL_TOKENS = ["<|bos|>", "<|eos|>", "<|pad|>", "<|unk|>"]
SPLITS = ["train", "val", "test"]
FLOW_NODES = ["Raw Data", "HTML Present", "English", "Filtered Out", "Final Kept"]

# --- published pre-tokeniser pattern of the base vocabulary ------------------
PRETOKEN = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# --- published patterns, with the character classes above in place of \s, \w and \d ----
_S, _W, _D = f"[{SPACE_CLASS}]", f"[{WORD_CLASS}]", DIGIT_CLASS

# HTML: a tag, an entity, the start of a script or style block, such a block, a comment.
TAG = rf"</?[A-Za-z][A-Za-z0-9]*(?:[{SPACE_CLASS}][^>]*)?>"
ENTITY = rf"&[A-Za-z]+;|&#{_D}+;"
SCRIPT_OPEN = rf"(?iu)<(?:script|style)(?:{_S}|>)"
SCRIPT_STYLE = r"(?isu)<script.*?>.*?</script>|<style.*?>.*?</style>"
COMMENT = r"(?s)<!--.*?-->"

# Code lines, weak set.
WEAK_CODE = [
    rf"^{_S}*def{_S}+{_W}+{_S}*\(",
    rf"^{_S}*return(?!{_W})",
    rf"^{_S}*function{_S}+{_W}+{_S}*\(",
    rf"#include{_S}+<{_W}+\.h>",
    rf"^{_S}*fn{_S}+{_W}+{_S}*\(",
    rf"^{_S}*(?:{'|'.join(VISIBILITY_WORDS)}){_S}+{_W}+{_S}+{_W}+{_S}*\(",
]

# Code lines, strong set, beside fence markers and keywords. Lines arrive stripped, so ^ and $ are the ends
# of the visible text.
STRONG_CODE = [
    r"^[^A-Za-z0-9]{4,}$",
    r";$",
    r"[{}]",
    rf"{_S}{_W}+{_S}*=[^=]",
    rf"^def{_S}+{_W}+{_S}*\(",
    rf"^(?:from|import){_S}+{_W}",
]

# Personal data. A local part is maximal to the left, so start only where one can start: the search stays
# linear on long runs of mailbox characters.
MAILBOX_CLASS = r"A-Za-z0-9._%+\-"
EMAIL = rf"(?<![{MAILBOX_CLASS}])[{MAILBOX_CLASS}]++@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}"
PHONE = rf"(?:(?<={_W})\+|(?<!{_W})){_D}[{_D}\-{SPACE_CLASS}]{{7,}}{_D}(?!{_W})"
CARD = rf"(?<!{_W}){_D}(?:[ \-]*{_D}){{12,15}}(?!{_W})"
