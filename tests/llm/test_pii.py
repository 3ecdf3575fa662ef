import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import pii


def plain(text):
    """Base spans by the patterns as they are stated, without the linear-time forms."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(digits(m.group())) <= 15]
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.@+-0123 9(5)é%\n_", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS] == plain(text)


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("my iban DE89 3704 0044 0532 0130 00 ok") == ["iban"]
    assert kinds("no DE88370400440532013000") == []
    assert kinds("SSN: 123-45-6789") == ["ssn"] and kinds("code 123-45-6789") == []
    assert kinds("call (555) 123-4567") == ["phone_local"]
    assert kinds("+1 (499) 555-6503") == ["phone"] and kinds("1.2.3.999 1.2.3.4") == ["ip"]


def test_ibans_before_capitals_and_digits():
    found = lambda t: [t[s:e] for kind, s, e, _ in pii.find_spans(t) if kind == "iban"]
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    assert pii.IBAN_CHARS["DE"] == 22 and pii.IBAN_CHARS["NO"] == 15 and pii.IBAN_CHARS["RU"] == 33
    for text in (f"IBAN {de} BIC COBADEFFXXX", f"account {gb} USD 500", f"{gb} {de}", f"AB12 {de} 7", f"DE88 3704 {de}. {gb},X",
                 f"IBAN {de}\nBIC", f"{gb}"):
        assert found(text) == [x for x in sorted((de, gb), key=text.find) if x in text], text
    assert found("DZ580002100001113000000570 BIC X") == ["DZ580002100001113000000570"]
    assert found(f"{gb}X") == found(f"{gb}x") == found(f"X{gb}") == found("DE88370400440532013000 BIC COBADEFFXXX") == []
    assert pii.redact(f"IBAN {de} BIC COBADEFFXXX") == "IBAN [IBAN] BIC COBADEFFXXX"
    assert pii.find_spans("AB12 " * 80_000) == [] and len(found(f"{gb} " * 3_000)) == 3_000


def test_long_texts_take_linear_time():
    for text in ("a" * 400_000, "a.b@" * 100_000, "1" * 400_000, "1." * 200_000, "+1 " + "(" * 400_000, "@" * 400_000):
        pii.find_spans(text)


def test_redaction_keeps_rows_and_counts(spark):
    rows = [(1, "mail a@b.co now"), (1, "mail a@b.co now"), (None, None), (2, ""), (3, "é +1 (499) 555-6503")]
    docs = with_clashes(docs_of(spark, rows))
    out = pii.redact_documents(docs)
    assert out.columns == docs.columns
    assert sorted((r.text or "", r.n_chars) for r in out.collect() if r.text is not None) == [
        ("", 0), ("mail [EMAIL] now", 16), ("mail [EMAIL] now", 16), ("é [PHONE]", 9)]
    found = {r.doc_id: [tuple(s)[:3] for s in r.spans] for r in pii.find_personal_data(docs).collect()}
    assert found == {None: [], 1: [("email", 5, 11)], 2: [], 3: [("phone", 2, 19)]}
    assert pii.find_personal_data(docs.limit(0)).count() == 0 and pii.redact_documents(docs.limit(0)).count() == 0


def overlaps_base(text, start, end):
    return any(a < end and start < b for _, a, b in plain(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["123-45-6789", "ssn ", "call ", "555-123-4567", "(555) 123-4567", "a@b.cd", "+1 555 123 4567", "1.2.3.4",
                                 " ", ",", "4111111111111111", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "x"]), max_size=12))
def test_added_spans_are_those_beside_base_ones_with_enough_score(parts):
    """Every form is tried at its own pattern's matches; overlaps are looked up in all base spans."""
    text = "".join(parts)
    want = []
    for kind, spans in (("iban", pii.find_ibans(text)), ("ssn", [m.span() for m in pii._SSN.finditer(text)]),
                        ("phone_local", [m.span() for m in pii._PHONE_LOCAL.finditer(text)])):
        for s, e in spans:
            near = (text[max(0, s - pii.CONTEXT_CHARS):s] + " " + text[e:e + pii.CONTEXT_CHARS]).lower()
            hit = any(w in pii.CONTEXT_WORDS[kind] for w in re.findall(r"[^\W\d_]+", near))
            if not overlaps_base(text, s, e) and pii.FORM_SCORE[kind] + 0.3 * hit >= pii.THRESHOLD - 1e-9:
                want.append((kind, s, e))
    assert [x[:3] for x in pii.find_spans(text) if x[0] not in pii.BASE_KINDS] == want


def test_many_spans_of_one_text_take_linear_time():
    import time
    text = "a@b.cd ssn 123-45-6789 " * 50_000
    began = time.process_time()
    assert len(pii.find_spans(text)) == 100_000
    assert time.process_time() - began < 12
