"""run() against a brute-force version of its stages, and the registered queries against their SQL."""

import hashlib

import pytest

from tests.oracle import compare

from .test_operators import WORDS, brute_licenses, brute_near, brute_quality, quality_tables


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer
    texts, labels = quality_tables(spark)
    texts += [(900, texts[1][1]), (901, texts[1][1] + " tail"), (902, None), (903, "")]
    spark.createDataFrame([(i, t, "en") for i, t in texts], "doc_id long, text string, lang string").write.parquet(
        str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    clean = [(i, t) for i, t in texts if t and "!!" not in t]
    last = {t: i for i, t in sorted(clean)}
    unique = sorted((i, t) for t, i in last.items())
    component = {i: kept for i, _, _, kept in brute_near(unique)}
    final = {i: t for i, t in unique if component[i]}
    assert len(final) < len(unique) < len(clean)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang"], name
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    t = Tokenizer.from_str(WORDS.text)
    want = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in final.items()}
    assert {r.doc_id: r.doc_tokens for r in got} == want
    assert sum(r.length for r in got) == sum(want.values())


def test_copies_stage_keeps_one_row(spark, tmp_path):
    import corpus_pipeline
    rows = [(1, "a", "x"), (1, "a", "y"), (2, "a", "x"), (None, "b", "x"), (None, "b", "x"), (3, None, "x"), (4, "", "x"), (2, "c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = corpus_pipeline.drop_copies(spark, df, "").collect()
    assert sorted(((r.doc_id, r.text or "") for r in got), key=repr) == sorted([(2, "a"), (None, "b"), (4, ""), (2, "c")], key=repr)
    twice = spark.createDataFrame([(7, "a", "x"), (7, "a", "x")], "doc_id long, text string, lang string")
    assert corpus_pipeline.drop_copies(spark, twice, "").count() == 1


def test_near_copies_stage_tells_rows_apart(spark):
    import corpus_pipeline
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    b = "quite another text that has nothing to do with the first one"
    rows = [(1, a, "x"), (5, a + " more", "x"), (5, b, "x"), (7, "third text, unrelated to both of them", "x"),
            (7, b.upper(), "y"), (5, "", "x"), (8, None, "x"), (None, a, "x"), (None, "without id or twin, all alone here", "x"),
            (9, "w " * 100_000, "x"), (9, "w " * 100_000, "x"), (10, b, "x"), (5, b.title(), "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted(((r.doc_id, r.text or "") for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()), key=repr)
    kept_b = min([b, b.title()], key=lambda t: hashlib.sha256(t.encode()).digest())
    want = [(1, a), (5, kept_b), (7, rows[3][1]), (5, ""), (8, ""), (None, rows[8][1]), (9, rows[9][1])]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("stage", range(4))
def test_stages_on_an_empty_table(spark, tmp_path, stage):
    import corpus_pipeline
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    out = corpus_pipeline.STAGES[stage][1](spark, empty, str(tmp_path))
    assert out.count() == 0 and (stage == 3 or out.columns == empty.columns)


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op6_top_k", "op9_url_rules", "op12_merkle"])
def test_query_equals_sql(spark, name):
    result = compare(spark, name, "/root/testdata/sf0.001")
    assert result["cols_match"] and result["values_match"], result


def test_near_dup_query(spark):
    from threadloom.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op2_near_dup"](spark, "/root/testdata/sf0.001").collect()), key=repr) == brute_near(docs)


def test_licenses_query(spark):
    from threadloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: ([tuple(m) for m in r.matches], r.has_unmatched) for r in QUERIES["op8_licenses"](spark, sf).collect()}
    assert got == {i: brute_licenses(t) for i, t in texts.items()}
    assert any(found for found, _ in got.values())


@pytest.mark.parametrize("stage", range(4))
def test_stages_on_very_long_texts(spark, tmp_path, stage):
    """A text of 1 MB, one without any space, nulls, and columns named like those the stages add."""
    import corpus_pipeline
    texts, labels = quality_tables(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    long = " ".join(f"tion{i * 7 % 60}" for i in range(150_000))
    rows = [(i, t, "x", True, 1) for i, t in texts] + [(2000, long, None, None, None), (2001, "z" * 500_000, "x", False, 2), (None, None, "x", True, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, component_id boolean, length int").repartition(3)
    out = corpus_pipeline.STAGES[stage][1](spark, df, str(tmp_path))
    if stage == 0:  # most of the raw n-grams are the long text's own
        known = {i: i % 5 > 0 for i in range(0, 400, 2)}
        want = brute_quality([(r[0], r[1]) for r in rows if r[1]], known)
        kept = {r.doc_id: r.text for r in out.collect()}
        assert out.columns == df.columns and kept == {r[0]: r[1] for r in rows if r[1] and want[r[0]][3]}
    elif stage < 3:
        assert out.columns == df.columns and out.where("doc_id = 2000").select("text").collect()[0].text == long
    else:
        from tokenizers import Tokenizer
        n = len(Tokenizer.from_str(WORDS.text).encode(long, add_special_tokens=False).ids) + 1
        pieces = [r for r in out.where("doc_id = 2000").collect()]
        assert sum(r["length"] for r in pieces) == n and {r.doc_tokens for r in pieces} == {n}
        assert sum(r["length"] for r in out.where("doc_id IS NULL").collect()) == 1


def test_quality_query_on_held_out_labels(spark):
    from threadloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    kept = QUERIES["op7_quality"](spark, sf).select("doc_id", "kept")
    joined = kept.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("pmod(xxhash64(doc_id), 5) = 0").collect()
    good = [r.kept for r in joined if r.quality == 1]
    bad = [r.kept for r in joined if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
