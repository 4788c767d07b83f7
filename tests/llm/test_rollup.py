import duckdb
import public_tokenizers
import pytest
from conftest import SF_CHECK, SF_SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agroframe.llm.queries import ORACLES, QUERIES
from agroframe.llm.rollup import Rollup, revisions, tokenizer_counts
from agroframe.llm.tokens import byte_bpe, word_bpe

FEED = "source string, lang string, tokenizer string, old_tokens long, new_tokens long"


def feed(spark, rows):
    return spark.createDataFrame(rows, FEED)


def totals(store):
    return {tuple(r)[:3]: tuple(r)[3:] for r in store.totals().collect()}


def test_signed_changes_and_replays(spark, tmpdir_path):
    store = Rollup(spark, f"{tmpdir_path}/r")
    assert totals(store) == {}
    load = feed(spark, [("a", "en", "v1", None, 10), ("a", "en", "v1", None, 10), (None, "en", "v1", None, 3), ("b", None, "v1", None, 0),
                        ("c", "en", "v1", None, None)])
    assert store.apply("load", load) and not store.apply("load", load)
    base = {("a", "en", "v1"): (2, 20), (None, "en", "v1"): (1, 3), ("b", None, "v1"): (1, 0)}
    assert totals(store) == base
    assert store.apply("revise", feed(spark, [("a", "en", "v1", 10, 14), ("a", "en", "v2", None, 7)]))
    assert store.apply("delete", feed(spark, [(None, "en", "v1", 3, None)]))
    assert store.apply("nothing", feed(spark, []))
    want = {("a", "en", "v1"): (2, 24), ("a", "en", "v2"): (1, 7), ("b", None, "v1"): (1, 0)}
    assert totals(store) == want
    store.compact("one")
    assert totals(store) == want and {"load", "revise", "delete", "nothing"} <= store.committed()
    assert not store.apply("revise", load) and totals(store) == want
    assert store.apply("again", feed(spark, [("b", None, "v1", 0, None)]))
    want.pop(("b", None, "v1"))
    assert totals(Rollup(spark, f"{tmpdir_path}/r")) == want


def test_a_batch_that_broke_off_is_not_counted(spark, tmpdir_path, monkeypatch):
    store, rows = Rollup(spark, f"{tmpdir_path}/r"), feed(spark, [("a", "en", "v1", None, 10)])

    def lost(_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(store, "_commit", lost)
        store.apply("load", rows)
    assert totals(store) == {}
    assert store.apply("load", rows) and totals(store) == {("a", "en", "v1"): (1, 10)}


def test_two_writers_of_one_batch_count_once(spark, tmpdir_path, monkeypatch):
    """The second writer commits between the first one's check and its commit, before and after a compaction."""
    slow, quick = (Rollup(spark, f"{tmpdir_path}/r") for _ in range(2))
    rows = feed(spark, [("a", "en", "v1", None, 10)])
    commit = slow._commit

    def overtaken(wanted, compact=False):
        assert quick.apply(wanted[0][0], rows)
        if compact:
            quick.compact()
            quick.vacuum()
        commit(wanted)

    monkeypatch.setattr(slow, "_commit", overtaken)
    assert slow.apply("load", rows) and totals(slow) == totals(quick) == {("a", "en", "v1"): (1, 10)}
    monkeypatch.setattr(slow, "_commit", lambda wanted: overtaken(wanted, compact=True))
    assert slow.apply("more", rows) and totals(slow) == totals(quick) == {("a", "en", "v1"): (2, 20)}
    assert not quick.apply("more", rows) and quick.committed() == {"load", "more"}


def test_a_batch_committed_during_compaction_counts_once(spark, tmpdir_path, monkeypatch):
    store, other = (Rollup(spark, f"{tmpdir_path}/r") for _ in range(2))
    store.apply("one", feed(spark, [("a", "en", "v1", None, 10)]))
    sums = store._totals

    def meanwhile(now):
        other.apply("two", feed(spark, [("a", "en", "v1", None, 5)]))
        return sums(now)

    with monkeypatch.context() as m:
        m.setattr(store, "_totals", meanwhile)
        store.compact()
    assert totals(store) == {("a", "en", "v1"): (2, 15)}


def test_the_log_shrinks(spark, tmpdir_path):
    store = Rollup(spark, f"{tmpdir_path}/r")
    assert store.vacuum() == 0
    for i in range(4):
        store.apply(f"b{i}", feed(spark, [("a", "en", "v1", None, 1)]))
    assert store.vacuum() == 0
    store.compact()
    store.apply("late", feed(spark, [("a", "en", "v1", None, 1)]))
    assert store.vacuum() == 4 and len(store._snapshot().files) == 1
    store.compact()
    assert store.vacuum() == 1 and store.vacuum() == 0
    assert totals(store) == {("a", "en", "v1"): (5, 5)} and not any(store.apply(b, None) for b in ["b0", "b3", "late"])


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    order = "source, lang, tokenizer, docs, tokens"
    want = con.sql(f"SELECT {order} FROM ({ORACLES['op5_token_rollup']}) ORDER BY ALL").fetchall()
    assert sorted(map(tuple, QUERIES["op5_token_rollup"](spark, SF_CHECK).select(*order.split(", ")).collect())) == want


def test_counts_of_tokenizer_files_and_revised_documents(spark, tmpdir_path):
    """Totals of two tokenizers after edits, moves, deletes and inserts equal SQL over the stored counts."""
    files = {"byte": byte_bpe(50_000), "word": word_bpe(50_000)}
    odd = spark.createDataFrame([(None, None, "en", None), (-1, "x", None, ""), (-1, "x", None, "a <|endoftext|> b")],
                                "doc_id long, source string, lang string, text string")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "lang", "text").unionByName(odd)
    edited = (docs.where("doc_id is null or doc_id % 7 <> 3")
              .withColumn("text", F.when(F.col("doc_id") % 5 == 1, F.concat("text", F.lit(" and more"))).otherwise(F.col("text")))
              .withColumn("lang", F.when(F.col("doc_id") % 11 == 2, "xx").otherwise(F.col("lang"))))
    for name, df in (("before", docs), ("after", edited)):
        tokenizer_counts(df.withColumn("tokens", F.lit("x")), files).write.parquet(f"{tmpdir_path}/{name}")
    before, after = (spark.read.parquet(f"{tmpdir_path}/{n}") for n in ("before", "after"))
    plain = {"byte": Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")),
             "word": Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))}
    want = sorted((str(r.doc_id), name, len(t.encode(r.text or "", add_special_tokens=False).ids))
                  for r in docs.collect() for name, t in plain.items())
    assert sorted((str(r.doc_id), r.tokenizer, r.tokens) for r in before.collect()) == want
    store = Rollup(spark, f"{tmpdir_path}/store")
    for batch, changes, state in (("load", revisions(None, before), "before"), ("edit", revisions(before, after), "after"),
                                  ("edit", revisions(before, after), "after")):
        store.apply(batch, changes)
        sql = f"SELECT source, lang, tokenizer, count(*), sum(tokens) FROM '{tmpdir_path}/{state}/*.parquet' GROUP BY ALL"
        assert totals(store) == {r[:3]: r[3:] for r in duckdb.sql(sql).fetchall()}
    store.apply("clear", revisions(after, None))
    assert totals(store) == {}
    assert tokenizer_counts(docs.limit(0), files).isEmpty()
