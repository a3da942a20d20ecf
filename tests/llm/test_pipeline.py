import corpus_pipeline


def test_stages_keep_the_columns_and_clean_documents(spark, tmp_path):
    clean = "A quiet morning by the river where {} walked along the old stone bridge and looked at boats. "
    rows = [(i, clean.replace("{}", f"person{i}") + f"Number {i * 7919} closes day {i * i * 31} for all who went home after it was over and done.", "en", "s", 0) for i in range(30)]
    rows += [(100, rows[0][1], "en", "s", 0), (101, None, "en", "s", 0), (102, "", "en", "s", 0), (None, "no id here at all.", "en", "s", 0)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    leak = "An entirely different question about the boiling point of water at high altitude and why it changes"
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert 100 not in ids and 0 in ids and None in ids
    assert corpus_pipeline.decontaminate(spark, docs, folder).count() == len(rows)
    assert corpus_pipeline.redact_secrets(spark, docs, folder).columns == columns
    assert corpus_pipeline.classify_quality(spark, docs, folder).columns == columns
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_every_operator_has_a_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def dedup(spark, rows, schema):
    docs = spark.createDataFrame(rows, schema)
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    return sorted(map(tuple, out.collect()), key=str)


def test_near_duplicates_are_told_apart_by_row(spark):
    t, u = "one two three four five six", "quite another text about some other things"
    schema = "doc_id bigint, text string, `row` int, `a.b` int, component_id int, first int"
    rows = [(1, t), (1, t), (2, t), (3, u), (3, t), (None, "a third text that nobody else has"), (None, u), (4, None), (None, "")]
    kept = dedup(spark, [(*r, 1, 2, 3, 4) for r in rows], schema)
    assert [r[:2] for r in kept] == [(1, t), (3, u), (4, None), (None, "a third text that nobody else has")]
    assert dedup(spark, [], schema) == []
