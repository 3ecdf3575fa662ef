"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Base kinds (email, ip, card, phone) are decided by form and checksum alone.  Further kinds
(iban by mod-97, ssn and national phone numbers by form) are added when checksum and nearby words
raise their score to the threshold.  Offsets are code points, the end is exclusive."""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import map_batches, text_or_empty

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "phone_local")
THRESHOLD = 0.7
CONTEXT_CHARS = 40
CONTEXT = {
    "email": "mail email contact write correo courriel",
    "ip": "ip address host server adresse",
    "card": "card visa credit debit mastercard amex tarjeta carte karte",
    "phone": "call phone tel mobile fax telefon telefono",
    "iban": "iban bank account konto cuenta compte",
    "ssn": "ssn social security",
    "phone_local": "call phone tel mobile fax telefon telefono",
}
CONTEXT_WORDS = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}
#: score of a match by its form (and checksum where the kind has one); context adds 0.3
FORM_SCORE = {"email": 0.9, "ip": 0.8, "card": 0.9, "phone": 0.8, "iban": 0.8, "ssn": 0.5, "phone_local": 0.4}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_IBAN_END = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
#: characters of an IBAN by country
IBAN_CHARS = {country: int(row[:2]) for row in """15 NO|16 BE|18 DK FI FK FO GL NL SD|19 MK SI
|20 AT BA EE KZ LT LU MN XK|21 CH HR LI LV|22 BG BH CR DE GB GE IE ME RS VA|23 AE GI IL IQ OM SO TL
|24 AD CZ ES MD PK RO SA SE SK TN VG|25 LY PT ST|26 IS TR|27 BI DJ FR GR IT MC MR SM
|28 AL AZ BY CY DO GT HN HU LB NI PL SV|29 BR EG PS QA UA|30 JO KW MU YE|31 MT SC|32 LC|33 RU""".split("|")
              for country in row[2:].split()}
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_PHONE_LOCAL = re.compile(r"(?<![0-9+)-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
_NON_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")
_SEED = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an IBAN without spaces."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(ch, 36)) for ch in turned)) % 97 == 1


def find_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches in linear time: the local part is walked back from each @."""
    out, floor = [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        after = at + 1
        if domain:
            start = at
            while start > floor and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                floor = after = domain.end()
                out.append((start, floor))
        at = text.find("@", after)
    return out


def find_ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping IBANs: of each start's longest match, the part of its country's length, else (for an
    unlisted country) the longest part of 15 characters or more that ends with a word and passes the check."""
    out, m = [], _IBAN.search(text)
    while m:
        start, after, chars = m.start(), m.start() + 1, IBAN_CHARS.get(m.group()[:2])
        for stop in reversed([e.start() for e in _IBAN_END.finditer(text, start, m.end() + 1) if e.start() <= m.end()]):
            iban = text[start:stop].replace(" ", "")
            if (len(iban) == chars if chars else len(iban) >= 15) and mod97(iban):
                out.append((start, stop))
                after = stop
                break
        m = _IBAN.search(text, after)
    return out


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _base(text: str) -> dict[str, list[tuple[int, int]]]:
    cards, phones = [], []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            cards.append(m.span())
    if "+" in text:
        phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NON_DIGIT.sub("", m.group())) <= 15]
    return {"email": find_emails(text),
            "ip": [m.span() for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))],
            "card": cards, "phone": phones}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    hit = not CONTEXT_WORDS[kind].isdisjoint(w.lower() for w in _WORD.findall(near))
    return round(min(1.0, FORM_SCORE[kind] + 0.3 * hit), 3)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in the order of ``KINDS``, then start."""
    if not text or not _SEED.search(text):
        return []
    base = _base(text)
    taken = sorted(s for spans in base.values() for s in spans)
    starts, furthest = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    out = [(kind, s, e, _score(text, kind, s, e)) for kind in BASE_KINDS for s, e in base[kind]]
    for kind, spans in (("iban", find_ibans(text)), ("ssn", [m.span() for m in _SSN.finditer(text)]),
                        ("phone_local", [m.span() for m in _PHONE_LOCAL.finditer(text)])):
        for s, e in spans:
            before = bisect_left(starts, e)
            if before and furthest[before - 1] > s:  # a base span begins before this one's end and ends behind its start
                continue
            score = _score(text, kind, s, e)
            if score >= THRESHOLD:
                out.append((kind, s, e, score))
    return out


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    spans = sorted((s, e, kind) for kind, s, e, _ in find_spans(text))
    if not spans:
        return text
    parts, end = [], 0
    for s, e, kind in spans:
        if s >= end:
            parts += [text[end:s], f"[{kind.upper()}]"]
        end = max(end, e)
    return "".join(parts) + text[end:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` -> (id, spans array of kind/start/end/score), one row a document, by kind then start.

    Null and empty texts have no spans.  Null or repeated ids are carried as they are; other
    columns are ignored.  Texts are independent: one Arrow map over whole texts, no shuffle."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(x.as_py())]
                 for x in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_SPAN))], ["id", "spans"])

    out = map_batches(rows, run, f"id {dict(docs.dtypes)[id_col]}, "
                                 "spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    return out.withColumnRenamed("id", id_col)


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_documents(docs: DataFrame, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data in the text replaced by kind marks and ``n_chars`` counted anew.

    Every row stays; a null text stays null (its length too).  All other columns are carried."""
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(at)
        texts = pa.array([redact(x.as_py()) for x in column], column.type)
        return batch.set_column(at, batch.schema.field(at), texts)

    def each(batches):
        for batch in batches:
            yield run(batch)

    out = docs.mapInArrow(each, docs.schema)
    if n_chars_col in docs.columns:
        out = out.withColumn(n_chars_col, F.char_length(text_col).cast(dict(docs.dtypes)[n_chars_col]))
    return out
