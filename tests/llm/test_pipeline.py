"""The pipeline against the stages' own meaning, on the small tables."""


from tests.llm.test_corpus import _cut_by_hand


def test_stages(spark, small):
    import corpus_pipeline as pipeline
    from stelae.llm import quality, simhash, toxicity
    from stelae.runtime import read_table, stored

    docs = read_table(spark, small, "documents")
    labels = read_table(spark, small, "labels")
    at, seen = docs, {}
    for name, stage in pipeline.STAGES:
        seen[name] = (at, at := stored(stage(spark, at, small), name))
        if name != pipeline.STAGES[-1][0]:
            assert set(at.columns) == set(docs.columns)
    before, after = seen["quality_classifier"]
    scores = {r.doc_id: r.score for r in quality.score(before, quality.train(before, labels)).collect()}
    assert {r.doc_id for r in after.collect()} == {k for k, s in scores.items() if s >= 0.3}
    before, after = seen["toxicity"]
    scores = {r.doc_id: r.score for r in toxicity.score(before, toxicity.train(before, labels)).collect()}
    assert {r.doc_id for r in after.collect()} == {k for k, s in scores.items() if s < 0.5}
    before, after = seen["simhash_near_dedup"]
    assert {r.doc_id for r in after.collect()} == {r.component_id for r in simhash.near_duplicates(before).collect()}
    before, after = seen["suffix_array_dedup"]
    cut = _cut_by_hand({r.doc_id: r.text for r in before.collect()})
    for r in after.collect():
        n_bytes, removed = cut[r.doc_id][:2]
        assert r.n_chars == len(r.text) and n_bytes - removed - 6 * cut[r.doc_id][2] <= len(r.text.encode()) <= n_bytes - removed
    packed = at.toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in after.select("doc_id").collect()}
    assert (packed.groupby("sequence_id").length.sum() <= 4096).all()
    assert pipeline.run(spark, small).count() == len(packed)


def test_rows_that_repeat_an_id(spark, small):
    import corpus_pipeline as pipeline

    rows = [(1, "one text of words", "en", "s", 17), (1, "one text of words", "en", "s", 17), (2, None, "en", "s", 0), (None, "no id here", "en", "s", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(str(r.doc_id) for r in pipeline.one_of_each_group(spark, docs, small).collect()) == ["1", "2", "None"]
    assert pipeline.cut_repeats(spark, docs, small).count() == 4


def test_cuts_leave_whole_characters_and_those_of_the_source(spark, small):
    import corpus_pipeline as pipeline
    from stelae.llm import suffix_dedup

    passage = "ein Absatz, der in zwei Dokumenten steht und lang genug ist, um zu gehen"
    rows = [(1, f"\u00e9{passage}\u00e9"), (2, f"a\ufffdb \u00e8{passage}\u00f1 c\ufffd\U0001f600"), (3, f"{passage}\ufffd"), (4, "x\ufffd")]
    docs = spark.createDataFrame([(k, t, "de", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pipeline.cut_repeats(spark, docs, small).collect()}
    # In 2 the repeat ends with the first byte of its last accent, which goes whole.
    want = {1: rows[0][1], 2: "a\ufffdb \u00e8 c\ufffd\U0001f600", 3: "\ufffd", 4: "x\ufffd"}
    assert got == {k: (t, len(t)) for k, t in want.items()}
    text = "a\u00e9\u4f60\U0001f600b\ufffd".encode()
    for a in range(len(text)):
        for b in range(a + 1, len(text) + 1):
            held = [c.encode() for c in text.decode()]
            ends = [sum(map(len, held[: i + 1])) for i in range(len(held))]
            whole = b"".join(h for h, e in zip(held, ends, strict=True) if e <= a or e - len(h) >= b)
            assert suffix_dedup._without(text, suffix_dedup._whole_characters(text, [(a, b)])) == whole


def test_different_texts_of_one_id_stay(spark, small):
    import corpus_pipeline as pipeline

    a, b = "the first text of words that repeats", "a wholly different text with other words in it"
    rows = [(1, a), (2, a), (2, b), (None, b), (None, "still another text without an id"), (3, None), (4, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((str(r.doc_id), r.text or "") for r in pipeline.one_of_each_group(spark, docs, small).collect())
    assert got == sorted([("1", a), ("2", b), ("3", ""), ("None", "still another text without an id")])


def test_stages_of_an_empty_table_and_of_further_columns(spark, small):
    import corpus_pipeline as pipeline
    from stelae.runtime import read_table

    docs = read_table(spark, small, "documents")
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.where("false"), small).count() == 0, name
    clash = [("score", "x"), ("kept", "y"), ("row", "z"), ("spans", "s"), ("label", "l"), ("carried", "c"), ("held", "h")]
    rows = [(1, "plain words of one text, long enough to be kept whole", "en", "s", 10), (2, None, "en", "s", 0), (3, "", None, None, None), (4, "word " * 30_000, "en", "s", 1)]
    odd = spark.createDataFrame([(*r, *[v for _, v in clash]) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n, _ in clash))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, odd, small)
        assert set(out.columns) == set(docs.columns) and out.count() in range(5), name
    assert pipeline.STAGES[-1][1](spark, odd, small).where("doc_id = 4").count() == -(-30_001 // 4096)
