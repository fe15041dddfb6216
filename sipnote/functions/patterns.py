"""Regular expressions shared by the column functions.

The character classes are spelled out because the regex engine's own shorthands are ASCII-only
by default and drop or keep other marks when switched to Unicode.

Every pattern that is tried at each position of a text starts with a class of single Latin
characters or with one range, which the engine tests directly. A class joined from several
parts is tested through a chain of calls, several times slower; such a class is only looked at
for a character that has passed the first test.
"""

from html.entities import html5

# The characters that count as white space (the blank is listed apart).
LATIN_SPACES = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}"
WIDE_SPACES = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

_CONTROLS = r"\x00\x01\x02\x03\x04\x05\x06\x07\x08\x0e\x0f\x10\x11\x12\x13\x14\x15\x16\x17\x18\x19\x1a\x1b\x7f"
_PUNCTUATION = r"""!"#$%&'()*+,\-./:;<=>?@\[\\\]\^`{|}~"""
_BEYOND_ASCII = r"\x{80}-\x{10ffff}"

LATIN_SPACE_RUN = f"[{LATIN_SPACES}]+"
WIDE_SPACE = f"[\\x{{1680}}-\\x{{3000}}](?<=[{WIDE_SPACES}])"
BLANK_RUN = "  +"

# Neither letter, digit, underscore nor white space: within ASCII, and beyond.
ASCII_SPECIAL_RUN = f"[{_CONTROLS}{_PUNCTUATION}]+"
OTHER_SPECIAL = f"[{_BEYOND_ASCII}&&[^\\p{{L}}\\p{{N}}{LATIN_SPACES}{WIDE_SPACES}]]+"
# The same characters and white space: whatever separates feature tokens.
ASCII_SEPARATOR_RUN = f"[{_CONTROLS}{_PUNCTUATION} \\t\\n\\x0b\\f\\r\\x1c\\x1d\\x1e\\x1f]+"
OTHER_SEPARATOR = f"[{_BEYOND_ASCII}&&[^\\p{{L}}\\p{{N}}]]+"

# Patterns that decide what is removed or found.
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
URL = f"https?://[^ {LATIN_SPACES}{WIDE_SPACES}]+|www\\.[^ {LATIN_SPACES}{WIDE_SPACES}]+"
REPEATED_CHAR = r"(?d)(.)\1\1+"
JAPANESE = r"[\x{3000}-\x{ffef}](?<=[\x{3000}-\x{303f}\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{ff00}-\x{ffef}\x{4e00}-\x{9faf}])"
# The inside of a tag: quoted values may hold ">".
_INSIDE = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
# Script, style and comments that are never closed end with the text.
HTML_MARKUP = (
    r"(?is)<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
    rf"|</?[a-z]{_INSIDE}>|</?[a-z][^>]*>|<[!?][^>]*>"
)
NAMED_ENTITY = r"^&([A-Za-z][A-Za-z0-9]*);"
DECIMAL_ENTITY = r"^&#0*([0-9]{1,7})(?![0-9])"
HEX_ENTITY = r"^&#[xX]0*([0-9a-fA-F]{1,6})(?![0-9a-fA-F])"
NUMBERED_ENTITY = r"^&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
# Names that old pages write without a semicolon.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
BARE_ENTITY = f"^&({'|'.join(BARE_NAMES)})"
LETTERS_ONLY = r"^\p{L}+$"

# The blank in front of a word that holds an apostrophe.
BLANK_BEFORE_APOSTROPHE_WORD = " (?=[^ ']*+')"
# Special characters at the outer ends of blank-separated words.
ASCII_BEFORE_WORD = f" {ASCII_SPECIAL_RUN}"
ASCII_BEHIND_WORD = f"{ASCII_SPECIAL_RUN}+(?= |$)"
ASCII_EDGES = f"^{ASCII_SPECIAL_RUN}|{ASCII_SPECIAL_RUN}$"
ANY_EDGES = r"^[^\p{L}\p{N}_]+|[^\p{L}\p{N}_]+$"
