import corpus_pipeline


def test_stages_take_effect(spark, words):
    import random

    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    clean = [prose(120) for _ in range(30)]
    near = clean[0].replace(clean[0].split()[60], "other", 1)
    rows = [(k, t) for k, t in enumerate(clean)] + [(100, clean[3]), (101, near), (102, "too short"), (103, clean[5] + " mail a.b@c.org"), (104, " ".join(w + "$$$" for w in prose(120).split()))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left[name] = {r.doc_id: r.text for r in docs.collect()}
    everything = {i for i, _ in rows}
    assert set(left["quality"]) == everything - {102, 104}
    assert set(left["exact_dedup"]) == everything - {102, 104, 3}
    assert set(left["near_dedup"]) == everything - {102, 104, 3, 101, 103}
    assert left["pii"] == left["near_dedup"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left["pii"])


def test_stages_judge_rows_of_repeated_and_null_identifiers(spark, words, repeated):
    import random

    from genpulse.llm.exact_dedup import one_of_equals
    from genpulse.llm.near_dedup import one_of_each
    from genpulse.llm.quality_rules import good_documents

    rng = random.Random(9)
    good, other, third = (" ".join(rng.choice(words) for _ in range(120)) + "." for _ in range(3))
    near = good.replace(good.split()[60], "changed", 1)
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    left = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    ordered = lambda rows: sorted(rows, key=repr)
    assert left(good_documents(make([(None, good), (None, "bad"), (1, other), (1, "bad"), (2, third)]))) == ordered([(None, good), (1, other), (2, third)])
    assert left(one_of_equals(make([(1, good), (1, good), (None, other), (None, other), (3, third), (3, good)]))) == ordered([(3, good), (None, other), (3, third)])
    assert left(one_of_equals(repeated)) in [ordered([(1, "same text"), (2, None)])]
    got = left(one_of_each(make([(1, good), (1, good), (None, near), (2, other), (2, third), (None, third), (None, None)])))
    assert got == ordered([(1, good), (2, other), (2, third), (None, None)])


CLASHING = "doc_id long, text string, row string, key string, hash string, kept string, n string, digest string, spans string, masked string, n_email string, base_sha256 string, _rejected string, _key string, _gone string"


def test_stages_leave_columns_of_clashing_names_alone(spark, words):
    import random

    from genpulse.llm.line_dedup import without_duplicate_lines

    rng = random.Random(10)
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    texts = [prose(120) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate([*texts, texts[0], "bad", None, texts[1] + " mail a.b@c.org"])]
    names = [f.split(" ")[0] for f in CLASHING.split(", ")]
    docs = spark.createDataFrame([(i, t, *[f"{c}{i}" for c in names[2:]]) for i, t in rows], CLASHING)
    for stage in [*[f for _, f in corpus_pipeline.STAGES[:-1]], lambda spark, docs, sf_dir: without_duplicate_lines(docs)]:
        out = stage(spark, docs, "").collect()
        assert len(out) >= 6
        for r in out:
            assert [r[c] for c in names[2:]] == [f"{c}{r.doc_id}" for c in names[2:]]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), "").count() == 0


def test_run_is_its_stages(spark):
    import hashlib

    sf_dir = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, sf_dir)
    got = {(r.doc_id, r.start, r.length, r.ids_crc32) for r in packed.collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    texts = [r.text for r in docs.select("text").collect()]
    assert len({hashlib.sha256(t.encode()).hexdigest() for t in texts}) == len(texts)
    assert {x[0] for x in got} == {r.doc_id for r in docs.select("doc_id").collect()}
