import hashlib

from conftest import SF_CHECK
from hypothesis import given
from hypothesis import strategies as st

from agroframe.llm import chat
from agroframe.llm.queries import QUERIES
from agroframe.session import materialize

PARTS = st.sampled_from(["<", "|", "\\", "im_start|>", "im_end|>", "\n", "<|im_end|>\n", "assistant", "é", " "])
TEXT = st.lists(PARTS, max_size=8).map("".join)


@given(st.lists(st.tuples(TEXT | st.just("assistant"), TEXT), max_size=5))
def test_template_round_trip(turns):
    text, begins, ends = chat.format_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[b:e]) for b, e in zip(begins, ends)] == [t for r, t in turns if r == "assistant"]
    assert all(chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t) for _, t in turns)


def _want(rows):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    out = []
    for c, turns in convs.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss)))
    return sorted(out)


def test_query_against_plain_python(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    hard = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", hard), (-1, 1, "assistant", hard)]
    got = QUERIES["op2_reply_trees"](spark, SF_CHECK).collect()
    assert sorted((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == _want(rows)
    assert all(r.formatted_chars > 0 for r in got)


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "assistant", "x"), (None, 1, "user", "y"),
            (2, 5, "user\n\\n", ""), (2, 5, "assistant", "<\\|"), (3, 1, "user", "long " * 5000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "conv_id long, turn long, role string, text string, tree string")
    got = chat.read_back(chat.format_conversations(df)).collect()
    assert sorted((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == _want(rows)
    assert chat.read_back(chat.format_conversations(df.limit(0))).count() == 0


def test_tree_paths_and_branches(spark):
    """Root 1 with replies 2 (-> 4 -> 5) and 3; a chain of 100; a cycle; an orphan."""
    edges = [(1, 1, None), (1, 2, 1), (1, 3, 1), (1, 4, 2), (1, 5, 4), (3, 7, 8), (3, 8, 7), (3, 9, 8), (4, 1, 99)]
    edges += [(2, i, i - 1 if i else None) for i in range(100)]
    df = spark.createDataFrame(edges, "tree long, node long, parent long")
    paths = chat.reply_paths(df)
    got = {}
    for r in paths.collect():
        got.setdefault((r.tree, r.leaf), {})[r.up] = r.node
    assert got == {(1, 5): {0: 5, 1: 4, 2: 2, 3: 1}, (1, 3): {0: 3, 1: 1}, (4, 1): {0: 1},
                   (2, 99): {i: 99 - i for i in range(100)}}
    df = df.selectExpr("*", "if(node = 3, 10.0D, 1.0D) score")
    ranked = chat.best_paths(df, best=2).select("tree", "leaf", "branch", "score").distinct().collect()
    assert sorted(map(tuple, ranked)) == [(1, 3, 1, 11.0), (1, 5, 2, 4.0), (2, 99, 1, 109.0), (4, 1, 1, 1.0)]
    texts = df.selectExpr("tree", "node", "'user' role", "concat('n', node) text")
    best = chat.format_paths(chat.best_paths(df), texts).where("tree = 1").collect()
    assert [chat.read_turns(r.formatted) for r in best] == [[("user", "n1"), ("user", "n3")]]


def test_a_comb_is_ranked_before_it_is_written_out(spark, monkeypatch):
    """A spine of 400 with a leaf at every node: 80,600 path rows in all, of which one path of 401 rows is written."""
    edges = [(1, i, i - 1 if i else None, 1.0) for i in range(400)] + [(1, 1000 + i, i, 0.5 if i != 250 else 900.0) for i in range(400)]
    df = spark.createDataFrame(edges, "tree long, node long, parent long, score double")
    written = []

    def counting(frame, name="stage"):
        out = materialize(frame, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(chat, "materialize", counting)
    got = {r.up: r.node for r in chat.best_paths(df).where("leaf = 1250 AND score = 1151.0 AND branch = 1").collect()}
    assert got == {0: 1250, **{i + 1: 250 - i for i in range(251)}}
    assert sum(written) <= 800 * 11


def test_random_forests_against_plain_python(spark):
    import random
    rng = random.Random(5)
    edges = []
    for tree in range(30):
        n = rng.randint(1, 40)
        for node in range(n):
            parent = rng.choice([None, 77, *range(node)]) if rng.random() < 0.95 else rng.randrange(n)
            edges.append((tree, node, parent, rng.choice([None, 0.0, 1.0, 2.0])))
    edges += [(None, 1, None, 1.0), (5, None, 1, 9.0)]
    above = {(t, n): p for t, n, p, _ in edges}
    score = {(t, n): s or 0.0 for t, n, _, s in edges}
    replied = {(t, p) for t, n, p, _ in edges if n is not None}
    want = {}
    for t, n in above:
        if t is None or n is None or (t, n) in replied:
            continue
        path = [n]
        while above[t, path[-1]] is not None and (t, above[t, path[-1]]) in above and len(path) <= 50:
            path.append(above[t, path[-1]])
        if len(path) <= 50:
            want.setdefault(t, []).append((-sum(score[t, x] for x in path), n, path))
    rows = spark.createDataFrame(edges, "tree long, node long, parent long, score double")
    got = {}
    for r in chat.best_paths(rows, best=3).collect():
        got.setdefault((r.tree, r.branch), []).append((r.up, r.node, r.score))
    assert {k: [n for _, n, _ in sorted(v)] for k, v in got.items()} == \
        {(t, i + 1): p[2] for t, ps in want.items() for i, p in enumerate(sorted(ps)[:3])}
    assert {k: v[0][2] for k, v in got.items()} == {(t, i + 1): -p[0] for t, ps in want.items() for i, p in enumerate(sorted(ps)[:3])}
