import corpus_pipeline as C
from campuslens.llm import jaccard_join, passages, sentencepiece_codec, toxicity
from campuslens.llm.queries import read, tokenizer_file

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order_on_given_documents(spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "jaccard_join", "passages", "mixing", "sentencepiece"]
    docs = read(spark, SF, "documents")
    first = docs
    frames = []
    for _, step in C.STAGES:
        out = step(spark, docs, SF)
        path = f"{C.scratch_path(spark, 'test-stage')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        frames.append(docs)
    toxic, joined, cut, mixed, encoded = frames
    for f in (toxic, joined, cut, mixed):
        assert f.columns == first.columns and f.dtypes == first.dtypes
    model = toxicity.train(first, read(spark, SF, "labels"), ~toxicity.held_out())
    clean = {r["doc_id"] for r in toxicity.score(first, model).where("predicted = 0").collect()}
    assert {r["doc_id"] for r in toxic.collect()} == clean
    classes = jaccard_join.similarity_classes(toxic).collect()
    assert sorted(r["doc_id"] for r in joined.collect()) == sorted({r["component_id"] for r in classes})
    marked = {r["doc_id"] for r in passages.repeated_passages(joined).collect()}
    before, after = ({r["doc_id"]: r["text"] for r in f.collect()} for f in (joined, cut))
    assert all(after[d] == t for d, t in before.items() if d not in marked)
    assert all(d not in after or len(after[d]) < len(before[d]) for d in marked)
    words = lambda f: sum(len((r["text"] or "").split()) for r in f.collect())
    assert abs(words(mixed) - words(cut)) <= 0.02 * words(cut) + 20
    assert encoded.count() == mixed.count() and encoded.where("NOT round_trip").count() == 0


def test_odd_documents_pass_through(spark):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (None, "no id but words", "en", "a", 15),
            (3, "some words here", "en", "a", 15), (3, "some words here", "en", "a", 15), (4, "x " * 30_000, "en", "b", 60_000)]
    docs = spark.createDataFrame(rows, DOCS)
    for name, step in C.STAGES:
        out = step(spark, docs, SF)
        out.collect()
        if name == "jaccard_join":
            assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "3", "4", "None"]
        if name in ("toxicity", "passages"):
            assert out.count() == 6
        assert step(spark, docs.limit(0), SF).count() == 0


def test_run_is_the_registered_query(spark):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    rows = C.run(spark, SF).collect()
    library = sentencepiece_codec.load(tokenizer_file("piece_bpe_32k.model"))
    assert rows and all(r["round_trip"] for r in rows) and library.kind == sentencepiece_codec.BPE


def test_the_mix_takes_whole_texts(spark):
    rows = [(d, " ".join(f"w{d}x{k}" for k in range(5 + 37 * d % 90)), "en", "abc"[d % 3], 0) for d in range(60)]
    rows += [(100, "long " * 5000, "en", "a", 25_000)]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = C.mix_sources(spark, docs, SF).collect()
    assert mixed and {(r["doc_id"], r["text"], r["n_chars"]) for r in mixed} <= {(r[0], r[1], r[4]) for r in rows}
    goals = {r["source"]: r for r in C.mixing.mix(docs).collect()}
    for source, goal in goals.items():
        words = sum(len(r["text"].split()) for r in mixed if r["source"] == source)
        assert abs(words - goal["target"]) <= 2501


def test_columns_of_any_name_pass_every_stage(spark):
    extra = ["_x", "_range", "_spans", "_doc", "size", "source_size", "target", "taken", "score", "predicted", "row",
             "component", "_whole", "x1", "a.b", "held"]
    rows = [(d, " ".join(f"w{d}x{k}" for k in range(30)), "en", "ab"[d % 2], 100 + d, *[f"{c}-{d}" for c in extra])
            for d in range(24)]
    rows += [(100 + d, r[1], *r[2:]) for d, r in enumerate(rows[:4])]
    schema = DOCS + ", " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame(rows, schema)
    given = {r[0]: r for r in rows}
    for name, step in C.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = [tuple(r) for r in out.collect()]
        assert got and all(r == given[r[0]] for r in got if name != "passages"), name
        assert all(r[5:] == given[r[0]][5:] for r in got), name


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark):
    text = lambda k, n=40: " ".join(f"t{k}w{i}" for i in range(n))
    rows = [(7, text(1), "en", "a", 1), (7, text(2), "en", "a", 2), (7, text(2), "en", "b", 3), (5, text(2), "en", "a", 4),
            (9, text(3) + " end", "en", "a", 5), (9, text(4), "en", "a", 6), (8, text(3), "en", "a", 7),
            (None, text(1), "en", "a", 8), (6, None, "en", "a", 9), (6, None, "fr", "a", 10)]
    kept = C.drop_near_copies(spark, spark.createDataFrame(rows, DOCS).repartition(3), SF).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in kept if r["doc_id"] != 6) == [
        ("5", 4), ("7", 1), ("8", 7), ("9", 6), ("None", 8)]
    assert len([r for r in kept if r["doc_id"] == 6]) == 1
