import random
import re

from tests.conftest import SF01
from tests.llm.helpers import with_clashes
from threadsmith.llm import quote_links as q

SCHEMA = "conv_id long, turn long, role string, text string"


def parse(text):
    out = []
    for line in re.sub(r"\r\n?", "\n", text or "").split("\n"):
        marks = re.match(r"(?:[ \t]*>)*", line).group()
        out.append((marks.count(">"), line[len(marks):].strip(" ")))
    return out


def norm(s):
    return " ".join(re.sub(r"[^\w\s]|_", " ", s.lower()).split())


def brute(rows):
    """{(conv, turn): (position, thread, parent, depth)} with one message a turn."""
    first = {}
    for c, t, _, text in sorted(rows):
        for level, body in parse(text):
            if level == 0 and len(norm(body)) >= q.LEAST_CHARS:
                first.setdefault((c, norm(body)), t)
    parent = {}
    for c, t, _, text in rows:
        votes, run, last = {}, 0, 0
        for level, body in parse(text):
            run += level != last
            last = level
            hit = first.get((c, norm(body)))
            if level and len(norm(body)) >= q.LEAST_CHARS and hit is not None and hit < t:
                votes.setdefault((run, level), {}).setdefault(hit, 0)
                votes[run, level][hit] += len(norm(body))
        best = [(-level, *max((n, o) for o, n in v.items())) for (_, level), v in votes.items()]
        parent[c, t] = max(best)[2] if best else None
    out = {}
    for c, t in parent:
        root, depth = t, 0
        while parent[c, root] is not None:
            root, depth = parent[c, root], depth + 1
        out[c, t] = (root, parent[c, t], depth)
    place = {}
    for c in {c for c, _ in out}:
        order = sorted((root, t) for (k, t), (root, _, _) in out.items() if k == c)
        place |= {(c, t): n for n, (_, t) in enumerate(order)}
    return {k: (place[k], *v) for k, v in out.items()}


def threads(rng, conv, n):
    rows, own = [], []
    for t in range(n):
        body = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(4)) + f" {t}"
        text = body
        if t and rng.random() < 0.7:
            k = rng.randrange(t)
            quoted = rows[k][3].split("\n")
            text = "Somebody wrote:\n" + "\n".join("> " + x for x in quoted) + "\n" + body
        rows.append((conv, t, "user", text))
        own.append(body)
    return rows, own


def test_threads_match_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    rows, own = [], {}
    for conv, n in ((1, 40), (2, 7), (3, 1), (4, 90)):
        got, bodies = threads(rng, conv, n)
        rows += got
        own.update({(conv, t): b for t, b in enumerate(bodies)})
    want = brute(rows)
    for stride in (4096, 8):
        monkeypatch.setattr(q, "STRIDE", stride)
        out = q.link_quotations(with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
        assert {(r.conv_id, r.turn): (r.position, r.thread_turn, r.parent_turn, r.depth) for r in out} == want
        assert all(r.text == own[r.conv_id, r.turn] for r in out)


def test_long_chain_and_hot_line(spark):
    chain = [(1, t, "u", ("" if not t else f"> line number {t - 1}\n") + f"line number {t}") for t in range(70)]
    hot = [(2, t, "u", "a very common first line\n> a very common first line") for t in range(50)]
    out = {(r.conv_id, r.turn): r for r in q.link_quotations(spark.createDataFrame(chain + hot, SCHEMA)).collect()}
    assert [out[1, t].depth for t in range(70)] == list(range(70))
    assert all(out[2, t].parent_turn == (0 if t else None) for t in range(50))


def test_short_quotes_link_to_the_only_earlier_message(spark):
    rows = [(1, 0, "u", "Ok, why?"), (1, 1, "u", "Another start"), (1, 2, "u", "> Ok, why?\nBecause."),
            (2, 0, "u", "yes"), (2, 1, "u", "Yes!"), (2, 2, "u", "> yes\nWhich one?"), (2, 3, "u", "> Which one?\nyes"),
            (3, 0, "u", "你好吗"), (3, 1, "u", "a"), (3, 2, "u", "> 你好吗\n很好"), (3, 3, "u", "> 很好\n> 你好吗\n你好吗"),
            (4, 0, "u", "why"), (4, 1, "u", "> why\n?"), (4, 2, "u", "why"), (5, 0, "u", "> why"), (6, 0, "u", "?"), (6, 1, "u", "> ?")]
    out = {(r.conv_id, r.turn): r for r in q.link_quotations(with_clashes(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()}
    linked = {k: r.parent_turn for k, r in out.items() if r.parent_turn is not None}
    assert linked == {(1, 2): 0, (2, 3): 2, (3, 2): 0, (3, 3): 0, (4, 1): 0}
    assert [out[1, t].position for t in range(3)] == [0, 2, 1]


def test_rewrapped_quotes_link(spark):
    words = [f"word{n}" for n in range(30)]
    long, cjk = " ".join(words), "今天天气很好我们一起去公园散步吧然后回家吃饭"
    wrapped = "\n".join("> " + " ".join(words[n:n + 7]) for n in range(0, 30, 7))
    rows = [(1, 0, "u", "Hello all,\n\n" + long + "\n\nBye"), (1, 1, "u", "else"), (1, 2, "u", wrapped + "\nno"),
            (1, 3, "u", "> Hello all,\n>\n" + wrapped + "\n>\n> Bye\n\nwhole"),
            (2, 0, "u", "\n".join(" ".join(words[n:n + 4]) for n in range(0, 30, 4))), (2, 1, "u", wrapped), (2, 2, "u", "> " + long),
            (3, 0, "u", cjk), (3, 1, "u", f"> {cjk[:9]}\n> {cjk[9:]}\nok"), (4, 1, "u", wrapped)]
    out = {(r.conv_id, r.turn): r for r in q.link_quotations(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert {k: r.parent_turn for k, r in out.items() if r.parent_turn is not None} == {
        (1, 2): 0, (1, 3): 0, (2, 1): 0, (2, 2): 0, (3, 1): 0}
    assert [out[1, t].n_linked for t in range(4)] == [0, 0, 1, 1]


def test_odd_rows(spark):
    rows = [(1, 0, "u", None), (1, 0, "u", None), (None, 1, "u", "x"), (2, None, None, "> y"), (3, 5, "u", "> " * 50 + "deep"),
            (4, 0, "u", "\n".join(["> long line here"] * 5000))]
    out = q.link_quotations(with_clashes(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(out) == len(rows)
    assert sorted(r.position for r in out if r.conv_id == 1) == [0, 1]
    assert all(r.position is None for r in out if r.conv_id is None or r.turn is None)
    assert [r.n_passages for r in out if r.conv_id == 4] == [1]
    assert q.link_quotations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_conversations_keep_their_rows(spark):
    table = spark.read.parquet(f"{SF01}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    want = brute(rows)
    got = {(r.conv_id, r.turn): (r.position, r.thread_turn, r.parent_turn, r.depth) for r in q.link_quotations(table).collect()}
    assert got == want
