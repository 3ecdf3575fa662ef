import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF01
from tests.llm.helpers import docs_of, with_clashes
from threadsmith.llm import decontaminate as d

ITEM = "Which of the following rivers flows through the largest number of capital cities, and what are their names?"
ITEMS = "item_id long, text string"


def distance(item, text):
    """Least edit distance of the item to a substring, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for k, y in enumerate(text, 1):
            new.append(min(row[k - 1] + (x != y), row[k] + 1, new[k - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=20), st.text("abc", max_size=40))
def test_myers_matches_the_table(item, text):
    assert d.myers(d.symbol_masks(item), len(item), text)[0] == distance(item, text)


def test_edits_within_the_budget_are_found_and_only_these(spark):
    rng = random.Random(6)
    texts = {}
    for i in range(60):
        passage = list(ITEM)
        for _ in range(i // 6):
            at = rng.randrange(len(passage))
            passage[at:at + rng.randint(0, 1)] = rng.choice(["", "x", "xy"])
        texts[i] = "Some words before. " * rng.randint(0, 5) + "".join(passage) + " And some after." * rng.randint(0, 5)
    items = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "Yes.")], ITEMS)
    got = {r.doc_id: r.edits for r in d.find_leaks(with_clashes(docs_of(spark, texts)), with_clashes(items)).collect()}
    low = {i: distance(d.normalise(ITEM), d.normalise(t)) for i, t in texts.items()}
    budget = d.edit_budget(len(d.normalise(ITEM)))
    assert got == {i: e for i, e in low.items() if e <= budget} and 0 < len(got) < 60


def test_blocks_of_items_give_the_same_rows(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(d.find_leaks(docs, items).collect())
    texts = {r.doc_id: d.normalise(r.text) for r in docs.collect()}
    exact = {(i, r.item_id) for r in items.collect() for i, t in texts.items() if d.normalise(r.text) in t}
    assert exact == {(r.doc_id, r.item_id) for r in whole if r.edits == 0} and exact
    kept = d.drop_leaks(docs, items)
    assert {r.doc_id for r in kept.collect()} == set(texts) - {r.doc_id for r in whole}
    monkeypatch.setattr(d, "BLOCK_CHARS", 2000)
    assert sorted(d.find_leaks(docs, items).collect()) == whole


def test_short_items_are_found_inside_texts(spark):
    texts = {1: "He asked: Who  wrote Hamlet? Nobody knew.", 2: "who wrote hamlets?", 3: "Who wrote Hamlet?", 4: "xwho wrote hamlet?",
             5: "\u6211\u95ee\u8c01\u5199\u4e86\u5b83\u5417", 6: "who wrote it?", 7: "2+2=4, 12+2=4", 8: "12+2=4", 9: "who wrote hamlet"}
    items = spark.createDataFrame([(1, "Who wrote Hamlet?"), (2, "\u8c01\u5199\u4e86\u5b83"), (3, "2+2=4"), (4, "wrote hamlet")], ITEMS)
    docs = docs_of(spark, texts)
    got = {(r.doc_id, r.item_id): (r.edits, r.end_at) for r in d.find_leaks(docs, items).collect()}
    assert got == {(1, 1): (0, 27), (2, 1): (1, 16), (3, 1): (0, 17), (4, 1): (0, 18), (9, 1): (1, 16), (5, 2): (0, 6), (7, 3): (0, 5),
                   (1, 4): (0, 26), (3, 4): (0, 16), (4, 4): (0, 17), (9, 4): (0, 16)}
    assert sorted(r.doc_id for r in d.drop_leaks(docs, items).collect()) == [6, 8]


def test_every_length_is_found_within_its_budget(spark):
    """Items of 5 to 60 characters with 0 to 3 edits; those without a budget as whole words only."""
    rng = random.Random(8)
    words = "who wrote that play about a prince of some cold land and why did he do so"
    items, texts = [], {}
    for n in range(5, 61):
        item = words[:n].strip()
        items.append((n, item))
        for edits in range(4):
            chars = list(item)
            for at in rng.sample(range(1, len(chars) - 1), min(edits, len(chars) - 2)):
                chars[at] = "#"
            texts[n * 10 + edits] = f"intro ## {''.join(chars)} ## outro"
    got = {(r.doc_id, r.item_id): r.edits for r in d.find_leaks(
        docs_of(spark, texts), spark.createDataFrame(items, ITEMS)).collect()}
    for n, item in items:
        for doc, text in texts.items():
            low = distance(item, text)
            whole = any(not d.in_word(text, m.start()) and not d.in_word(text, m.end()) for m in re.finditer(re.escape(item), text))
            assert got.get((doc, n)) == (low if low <= d.edit_budget(len(item)) and (whole or d.edit_budget(len(item))) else None)


def test_odd_rows(spark):
    rows = [(1, ITEM), (1, ITEM), (None, ITEM.upper()), (2, None), (3, ""), (4, " yes. "), (5, "a" * 500_000)]
    docs = with_clashes(docs_of(spark, rows))
    items = spark.createDataFrame([(7, ITEM), (7, ITEM), (None, ITEM), (8, "Yes.")], ITEMS)
    found = d.find_leaks(docs, items)
    assert sorted(str(r.doc_id) for r in found.collect()) == ["1"] * 6 + ["4"] + ["None"] * 3
    assert sorted(r.doc_id for r in d.drop_leaks(docs, items).collect()) == [2, 3, 5]
    none = items.limit(0)
    assert d.find_leaks(docs, none).count() == 0 and d.drop_leaks(docs, none).count() == 7
    assert d.find_leaks(docs.limit(0), items).count() == 0
