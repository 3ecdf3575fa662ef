"""DuckDB twins of the column helpers, used to write the SQL oracles.

They mirror ``threadsmith.functions`` expression by expression so that the oracle is an
independent engine computing the same definition."""

from __future__ import annotations

from threadsmith.config import LINK_PLACEHOLDER, MEDIA_PLACEHOLDER
from threadsmith.functions.draws import sql_uniform
from threadsmith.functions.text import EXOTIC_SPACES, sentence_pattern

WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"
NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal (standard strings: backslashes are literal)."""
    return "'" + s.replace("'", "''") + "'"


def lit_text(s: str) -> str:
    """A literal that may contain newlines."""
    parts = s.split("\n")
    return " || chr(10) || ".join(q(p) for p in parts) if len(parts) > 1 else q(s)


def ascii_spaced(x: str) -> str:
    """Twin of ``functions.text.ascii_spaced``."""
    src = " || ".join(f"chr({ord(c)})" for c in EXOTIC_SPACES)
    return f"translate({x}, {src}, '{' ' * len(EXOTIC_SPACES)}')"


def py_strip(x: str) -> str:
    return f"trim({ascii_spaced(x)}, {WS})"


def sents(text: str, delimiters: str) -> str:
    pat = q(sentence_pattern(delimiters))
    return (f"list_transform(list_filter(regexp_extract_all({text}, {pat}), "
            f"lambda s: {py_strip('s')} NOT IN ('', '{MEDIA_PLACEHOLDER}', '{LINK_PLACEHOLDER}')), "
            f"lambda s: replace(s, {NL}, ''))")


def gate_len(text: str) -> str:
    return (f"length(replace(replace(replace(replace({text}, {NL}, ''), ' ', ''), "
            f"'{MEDIA_PLACEHOLDER}', ''), '{LINK_PLACEHOLDER}', ''))")


def gate(text: str, thresh: int) -> str:
    return f"({gate_len(text)} >= {thresh})"


def u(parts: list[str], salt: str, seed: str = "42") -> str:
    return sql_uniform(parts, salt, seed)


def pick(u_expr: str, n: str) -> str:
    """0-based index floor(u*n)."""
    return f"CAST(floor({u_expr} * ({n})) AS INTEGER)"


def english_list(arr: str) -> str:
    return (f"CASE WHEN len({arr}) = 1 THEN {arr}[1] WHEN len({arr}) > 1 THEN "
            f"array_to_string({arr}[1:len({arr})-1], ', ') || ' and ' || {arr}[len({arr})] END")


def words(text: str) -> str:
    return f"regexp_extract_all({text}, '\\p{{L}}+')"
