"""Text column helpers: sentence split, length gate, Python-style strip, list joins,
transcript quoting, filename-safe names, markdown escaping.

All helpers return ``Column`` expressions built from JVM functions (no Python UDF), so
they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsmith.config import LINK_PLACEHOLDER, MEDIA_PLACEHOLDER

# The characters Python's str.strip()/str.isspace() treat as whitespace
# (as a regex class body), and the ASCII subset used for trimming.
PY_SPACE_CLASS = (
    "\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)
TRIM_CHARS = " \t\n\r\x0b\x0c"
# line breaks recognised by str.splitlines()
LINE_BREAK = "(\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}])"
# characters the (dormant) markdown escaper prefixes with a backslash
MARKDOWN_SPECIAL = "\\_*[]()~`>#+-=|{}.!"
# characters replaced by '_' in file names (besides whitespace)
FILENAME_FORBIDDEN = "\"'*/\\:<>?|!@;,=."


def _lit(c) -> Column:
    return c if isinstance(c, Column) else F.lit(c)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def class_body(chars: str) -> str:
    """Escape characters for use inside a regex character class (Java and RE2)."""
    out = []
    for ch in chars:
        if ch == "\n":
            out.append("\\n")
        elif ch == "\t":
            out.append("\\t")
        elif ch == "\r":
            out.append("\\r")
        elif ch in "\\]^-[&":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def sentence_pattern(delimiters: str) -> str:
    """Pieces ending in a delimiter (delimiter kept on the left) or the trailing rest."""
    d = class_body(delimiters)
    return f"[^{d}]*[{d}]|[^{d}]+\\z"


# Whitespace characters of str.isspace() beyond Java's ASCII \s set.
EXOTIC_SPACES = ("\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                 + "\u2028\u2029\u202f\u205f\u3000")


def ascii_spaced(text) -> Column:
    """Map the non-ASCII whitespace characters to a space (1:1, so offsets and lengths
    are kept); afterwards Java's fast ASCII ``\\s``/``\\S`` classes give Python's
    whitespace semantics."""
    return F.translate(_col(text), EXOTIC_SPACES, " " * len(EXOTIC_SPACES))


def py_strip(c) -> Column:
    """Python ``str.strip()``: every ``str.isspace()`` character is stripped (non-ASCII
    spaces are first mapped to ' ', so the ASCII trim set suffices)."""
    return F.trim(ascii_spaced(_col(c)), F.lit(TRIM_CHARS))


def split_sentences(text, delimiters: str) -> Column:
    """Sentence segments: split after each delimiter, drop segments that are blank or
    only a media/link placeholder, then delete newlines inside the kept ones."""
    pieces = F.regexp_extract_all(_col(text), F.lit(sentence_pattern(delimiters)), 0)
    kept = F.filter(
        pieces,
        lambda s: ~py_strip(s).isin("", MEDIA_PLACEHOLDER, LINK_PLACEHOLDER),
    )
    return F.transform(kept, lambda s: F.replace(s, F.lit("\n"), F.lit("")))


def gate_length(text) -> Column:
    """Length that the response gate measures: newlines, spaces and the media/link
    placeholders removed (in that order); tabs and '(video)' count."""
    t = _col(text)
    for target in ("\n", " ", MEDIA_PLACEHOLDER, LINK_PLACEHOLDER):
        t = F.replace(t, F.lit(target), F.lit(""))
    return F.length(t)


def passes_gate(text, thresh: int) -> Column:
    return gate_length(text) >= F.lit(thresh)


def english_list(arr) -> Column:
    """``['a']`` -> ``a``; ``['a','b','c']`` -> ``a, b and c``."""
    a = _col(arr)
    n = F.size(a)
    return F.when(n == 1, F.element_at(a, 1)).when(
        n > 1,
        F.concat(
            F.array_join(F.slice(a, 1, n - 1), ", "),
            F.lit(" and "),
            F.element_at(a, -1),
        ),
    )


def quote_body(body) -> Column:
    """``'> ' + '\\n> '.join(body.splitlines())``."""
    b = F.regexp_replace(_col(body), F.lit(LINE_BREAK + "\\z"), F.lit(""))
    return F.concat(F.lit("> "), F.regexp_replace(b, F.lit(LINE_BREAK), F.lit("\n> ")))


def filename_safe(name) -> Column:
    """Forbidden characters and whitespace become '_'; other control characters
    (0x00-0x1F) are dropped; 0x7F is kept."""
    forbidden = class_body(FILENAME_FORBIDDEN)
    step1 = F.regexp_replace(_col(name), F.lit(f"[{forbidden}{PY_SPACE_CLASS}]"), F.lit("_"))
    return F.regexp_replace(step1, F.lit("[\\x00-\\x1f]"), F.lit(""))


def escape_markdown(text, enabled: bool = False) -> Column:
    """Backslash-escape markdown specials and prefix newlines with two spaces.
    Disabled by default (the corpus is tokenised again later)."""
    t = _col(text)
    if not enabled:
        return t
    esc = F.regexp_replace(t, F.lit(f"([{class_body(MARKDOWN_SPECIAL)}])"), F.lit("\\\\$1"))
    return F.replace(esc, F.lit("\n"), F.lit("  \n"))


def words(text) -> Column:
    """Letter runs (the word tokens used for topic nouns)."""
    return F.regexp_extract_all(_col(text), F.lit("\\p{L}+"), 0)


def whitespace_tokens(text) -> Column:
    """Python ``str.split()`` tokens (runs of non-whitespace)."""
    return F.regexp_extract_all(ascii_spaced(text), F.lit("\\S+"), 0)
