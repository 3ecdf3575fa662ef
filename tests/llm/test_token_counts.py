import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import token_counts
from threadsmith.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)

ODD = ["", None, " ", "  \n\n  x ", "It's I'll'd 'S ''s x's's 'm", "a<|endoftext|>b <|endoftext|>", "<|endoftext|>" * 3,
       "  <|endoftext|>  ", "<|endoftext", "你好，世界 123٤२", "\U0001f600‍\U0001f525 é ՘࢏",
       "naïve ßİ café", "\x00\x01\x7f\t\r\n\x0b\x0c\x85 　", "zq" * 5000, "word " * 3000, "12 345678 9"]


def tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def found(docs, **options):
    rows = token_counts.count_tokens(docs, PATH, **options).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows), key=repr)


def wanted(pairs, limit=512):
    return sorted(((i, len((t or "").encode()), tokens(t), tokens(t) > limit) for i, t in pairs), key=repr)


@pytest.mark.parametrize("frequent", [0, 5, 200_000])
def test_odd_texts_nulls_repeats_and_clashes(spark, monkeypatch, frequent):
    monkeypatch.setattr(token_counts, "FREQUENT", frequent)
    pairs = [*enumerate(ODD), (3, ODD[3]), (3, ODD[4]), (None, "no id"), (None, "no id"), (None, None)]
    assert found(with_clashes(docs_of(spark, pairs))) == wanted(pairs)


def test_given_documents_agree_with_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows = QUERIES["op13_token_counts"](spark, SF001).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows), key=repr) == wanted(pairs)


def test_empty_table_and_limit(spark):
    assert found(docs_of(spark, {1: "x"}).where("false")) == []
    assert found(docs_of(spark, {1: "a b c"}), limit=2) == [(1, 5, 3, True)]


def test_settled_code_points_are_split_alike():
    """Every code point that the fast pattern may meet falls into the library's class."""
    import regex
    settled, pattern = regex.compile(token_counts.SETTLED), regex.compile(token_counts.PATTERN)
    points = [c for c in map(chr, range(0x10000)) if not "\ud800" <= c <= "\udfff" and settled.fullmatch(c)]
    for at in range(0, len(points), 4000):
        text = "".join(f"a{c}b1{c}2!{c}? {c}{c} x  {c}a  {c}1 {c}!" for c in points[at:at + 4000])
        assert pattern.findall(text) == [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]


def test_other_tokenizers_of_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["Café  AND  tea's 42", "<|startoftext|>x", "", "Á B"]
    rows = token_counts.count_tokens(docs_of(spark, list(enumerate(texts))), path).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {
        i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
