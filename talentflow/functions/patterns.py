"""Regular-expression fragments shared by the column functions.

Spark evaluates ``rlike``/``regexp_*`` with java.util.regex.  The upstream
behaviour was defined with Python's ``re`` on ``str``; the fragments below are
the Java spellings that give the same answers.
"""

from __future__ import annotations

# --- Fixed values: the characters Python's str-mode ``\s`` matches. ---------
# (tab, LF, VT, FF, CR, the four information separators U+001C..U+001F, space,
# NEL, NBSP, OGHAM SPACE MARK, EN QUAD..HAIR SPACE, LINE/PARAGRAPH SEPARATOR,
# NARROW NBSP, MEDIUM MATHEMATICAL SPACE, IDEOGRAPHIC SPACE.)
# Written with \x{...} escapes, which java.util.regex and RE2 both accept.
PY_WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# Unicode-aware, case-insensitive flags: (?i) case folding, (?U) Unicode
# character classes.  Java's own \\b and \\w are not used: they count combining
# marks and joiners as word characters, Python's do not.
UNICODE_CI = "(?iU)"

# The word characters of Python's re on str: letters, numbers, underscore.
WORD_CLASS = r"[\p{L}\p{N}_]"
AFTER_NON_WORD, AFTER_WORD = f"(?<!{WORD_CLASS})", f"(?<={WORD_CLASS})"
BEFORE_NON_WORD, BEFORE_WORD = f"(?!{WORD_CLASS})", f"(?={WORD_CLASS})"


def is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()

_PLAIN = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 _")


def escape_literal(text: str) -> str:
    """Escape ``text`` for java.util.regex so that it matches literally.

    Every ASCII character other than letters, digits, space and underscore is
    backslash-escaped (always legal in Java); non-ASCII characters are kept
    as they are.
    """
    out = []
    for ch in text:
        if ch in _PLAIN or ord(ch) > 127:
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "".join(out)
