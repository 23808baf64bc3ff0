"""The pipeline's stages against plain versions, each on what the stage before kept, and the queries as registered."""

import re
from collections import Counter

import corpus_pipeline
from tallyframe.llm import queries, toxicity
from tests.llm.test_operators import brute_components, brute_overlap, check_packing, item_tokens, word_sets
from tests.test_catalog import same_rows
from pyspark.sql import functions as F


def test_stages(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert [*steps] == ["toxicity", "ngram_jaccard", "decontamination", "pseudonyms", "best_fit_packing"]
    rows = {r.doc_id: r.text for r in docs.collect()}

    labels = spark.read.parquet(f"{data_dir}/labels.parquet")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(docs.filter(~out), labels.filter(~out))
    want = {r.doc_id for r in toxicity.score(docs, model).collect() if r.score < 0.5}
    clean = steps["toxicity"](spark, docs, data_dir).cache()
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == want and len(want) > 0.8 * len(rows)

    ids = sorted(want)
    groups = brute_components(word_sets([rows[i] for i in ids], 5), 80)
    firsts = steps["ngram_jaccard"](spark, clean, data_dir).cache()
    assert firsts.columns == columns and sorted(r.doc_id for r in firsts.collect()) == [i for k, i in enumerate(ids) if groups[k] == k]

    items = [item_tokens(r.text) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    left = steps["decontamination"](spark, firsts, data_dir).cache()
    got = {r.doc_id for r in left.collect()}
    gone = {r.doc_id for r in firsts.collect()} - got
    assert left.columns == columns
    for r in firsts.collect():
        words = item_tokens(r.text)
        held = any(" " + " ".join(i) + " " in " " + " ".join(words) + " " for i in items)
        assert not held or r.doc_id in gone
    assert all(any(brute_overlap(item_tokens(rows[i]), item) >= 0.5 for item in items) for i in gone)

    private = steps["pseudonyms"](spark, left, data_dir).cache()
    assert private.columns == columns
    for r in private.collect():
        old = rows[r.doc_id]
        assert len(old) - 12 <= len(r.text) <= len(old) + 24
        for address in re.findall(r"(?<![\w.])[\w.]+@mail\d", old):
            assert address not in r.text

    pieces = steps["best_fit_packing"](spark, private, data_dir).toPandas()
    kept = {r.doc_id: r.text for r in private.collect()}
    assert set(pieces.doc_id) == set(kept)
    check_packing(pieces, kept, 2048)


def test_stages_on_odd_rows(spark, data_dir):
    """Null, empty, blank, long and repeated texts, null and repeated ids, further columns of clashing names, and no rows at all."""
    long = " ".join(f"word{i % 700}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " " * 30_000), (4, long), (5, long + " end"), (6, "see 10.1.2.3 now"), (None, "see 10.1.2.3 now"), (6, "a text of its own under an id that is there already"), (None, None), (7, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in ("id", "sig", "hub", "t", "doc", "_id", "root", "n", "_c0")})
    kept = {}
    for some, start in (("rows", docs), ("none", docs.limit(0))):
        step = start
        for name, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, data_dir).cache()
            kept[some, name] = [r.asDict() for r in step.collect()]
            if name != "best_fit_packing":
                assert step.columns == docs.columns
    assert all(not found for (some, _), found in kept.items() if some == "none")
    left = [(r["doc_id"], r["text"]) for r in kept["rows", "decontamination"]]
    toxic = {r for r in rows} - {(r["doc_id"], r["text"]) for r in kept["rows", "toxicity"]}
    assert {*left} == {*rows} - toxic - {(5, long + " end")}
    private = [r["text"] for r in kept["rows", "pseudonyms"] if (r["text"] or "").startswith("see")]
    assert len({*private}) <= 1 and "see 10.1.2.3 now" not in private
    pieces = kept["rows", "best_fit_packing"]
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(i for i, _ in left)


def test_queries_against_sql(spark, data_dir):
    for name, sql in queries.ORACLES.items():
        same_rows(spark, queries.QUERIES[name], sql, data_dir)


def test_a_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == [*range(1, 11)]
