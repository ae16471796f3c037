"""Portable regular expressions (Java regex, Unicode-aware).

Java's ``\\w`` is ASCII-only, so the word class is spelled out as
``[\\p{L}\\p{N}_]``; Java's Unicode ``\\s`` misses the information separators
``\\x1c-\\x1f`` that Python counts as whitespace, so they are added explicitly.
"""

W = r"\p{L}\p{N}_"                     # word characters
S = r"\s\x1c-\x1f"                      # whitespace characters

# pre-tokenizer for BPE: word with optional leading space | punctuation run with
# optional leading space | whitespace run not followed by non-space | whitespace run
CHUNK = rf"(?U) ?[{W}]+| ?[^{W}{S}]+|[{S}]+(?![^{S}])|[{S}]+"

# word tokenizer: a word, or one character that is neither word nor space
WORD = rf"(?U)[{W}]+|[^{W}{S}]"

# whitespace run (for "collapse whitespace")
WHITESPACE_RUN = rf"(?U)[{S}]+"

# line breaks recognised by Python's str.splitlines
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
