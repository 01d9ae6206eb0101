"""Each stage against its own input, and the whole run."""

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import sql


def sql_over(query, frame, sf_dir):
    con = duckdb.connect()
    con.register("documents", frame)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    return con.execute(query).df()


def test_python_gets_few_whole_texts_at_a_time_and_each_once(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, stored = spark.conf.get(name), corpus_pipeline.stored

    def noted(df):
        seen.append((spark.conf.get(name), df._jdf.queryExecution().optimizedPlan().toString()))
        return stored(df)

    monkeypatch.setattr(corpus_pipeline, "stored", noted)
    texts = ["the house is old and the road is long", "das Haus ist alt und der Weg ist lang", "", None]
    docs = spark.createDataFrame([(k, texts[k % 4], ("en", "de")[k % 2], "s", 1) for k in range(40)], "doc_id long, text string, lang string, source string, n_chars int")
    kept = corpus_pipeline.known_language(spark, docs, "")
    out = corpus_pipeline.tokens(spark, kept, "")
    assert kept.dtypes == docs.dtypes and out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert sorted(r.doc_id for r in out.collect()) == [k for k in range(40) if k % 4 < 2]
    assert [int(n) for n, _ in seen] == [1_000, 1_000] and "__text" not in seen[0][1]
    assert spark.conf.get(name) == before


def test_stages(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.toPandas()
        if name != "tokens":
            assert docs.columns == columns
    start = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    letters = start[start.text.map(lambda t: any(c.isalpha() for c in t or ""))]
    assert set(seen["language"].doc_id) <= set(letters.doc_id)
    assert len(seen["language"]) >= 0.97 * len(start)
    left = sql_over(sql.LINES, seen["language"], sf_dir).set_index("doc_id")
    import hashlib

    own = seen["lines"].set_index("doc_id")
    assert set(own.index) == set(left.index)
    assert all(hashlib.sha256((own.text[k] or "").encode()).hexdigest() == left.kept_sha256[k] for k in own.index)
    assert (own.n_chars == own.text.str.len()).all()
    groups = sql_over(sql.JACCARD, seen["lines"], sf_dir)
    assert set(seen["near_copies"].doc_id) == set(groups[groups.component_id == groups.doc_id].doc_id)
    leaks = sql_over(sql.DECONTAMINATE, seen["near_copies"], sf_dir)
    assert set(seen["decontamination"].doc_id) == set(seen["near_copies"].doc_id) - set(leaks.doc_id)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = seen["decontamination"].set_index("doc_id").text
    for row in seen["tokens"].itertuples():
        assert list(row.ids) == library.encode(texts[row.doc_id], add_special_tokens=False).ids
    whole = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(whole.doc_id) == set(texts.index)


def test_tokens_are_decoded(spark):
    """The last stage decodes its own ids, for repeated, null and empty rows too."""
    import hashlib

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = [(1, "Two words, 3 numbers\nand a line"), (1, "another text"), (None, "Été à la plage"), (2, ""), (3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id or 0, list(r.ids), r.decoded_sha256) for r in corpus_pipeline.tokens(spark, df, "").collect())
    want = []
    for k, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((k or 0, ids, hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)
