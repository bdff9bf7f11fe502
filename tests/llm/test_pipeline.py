"""The pipeline's stages: what each one keeps, changes and drops."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline as pipeline

SF_DIR = "/root/testdata/sf0.001"
INSULTS = "idiot clown worthless scum moron pathetic disgusting trash stupid loser".split()


def words(start, count):
    return " ".join(f"w{i}" for i in range(start, start + count))


@pytest.fixture(scope="module")
def docs(spark):
    passage = words(10_000, 60)
    rows = [
        (1, words(0, 80), "en", "a", 5),
        (2, words(0, 80), "en", "a", 5),
        (3, words(0, 79) + " changed", "en", "b", 5),
        (4, words(500, 80) + "\n" + passage, "en", "b", 5),
        (5, words(900, 80) + "\n" + passage + "\n" + words(2000, 10), None, None, None),
        (6, "mail a.b@c.de now", "en", "c", 5),
        (7, None, "en", "c", 5),
        (8, "", "en", "c", 0),
        (None, words(3000, 70), "en", "c", 5),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_the_stages_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "personal_data", "best_fit_packing"]
    assert contract.queries()["pipeline"] is pipeline.run


def test_toxicity_drops_insults_only(spark):
    large = "/root/testdata/sf0.1"
    given = spark.read.parquet(f"{large}/documents.parquet")
    kept = pipeline.toxicity(spark, given, large)
    assert kept.schema == given.schema
    before = {r.doc_id: r.text for r in given.collect()}
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    insulting = {i for i, t in before.items() if set(t.lower().replace(".", " ").replace(",", " ").split()) & set(INSULTS)}
    assert len(insulting & left) <= 0.05 * len(insulting)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{large}/labels.parquet").collect()}
    clean = [i for i, toxic in labels.items() if toxic == 0]
    assert sum(i not in left for i in clean) <= 0.02 * len(clean)


def test_line_dedup_drops_what_it_empties(spark, docs):
    rows = pipeline.line_dedup(spark, docs, SF_DIR)
    assert rows.schema.names == docs.schema.names
    left = {r.doc_id: r for r in rows.collect()}
    assert set(left) == {1, 3, 4, 5, 6, 7, 8, None}
    assert left[5].text == words(900, 80) + "\n" + words(2000, 10) and left[5].n_chars == len(left[5].text)
    assert left[7].text is None and left[8].text == "" and left[4].text.endswith(words(10_000, 60))


def test_near_duplicates_keep_one_of_each_group(spark, docs):
    rows = pipeline.near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 1, 4, 5, 6, 7, 8]
    nameless = docs.selectExpr("cast(NULL AS bigint) AS doc_id", "text", "lang", "source", "n_chars")
    left = pipeline.near_duplicates(spark, nameless, SF_DIR).collect()
    assert len(left) == 7 and len({r.text for r in left if r.text}) == 5
    twice = pipeline.near_duplicates(spark, docs.unionAll(docs), SF_DIR).collect()
    assert sorted((r.doc_id or 0) for r in twice if r.text) == [0, 1, 4, 5, 6]


def test_personal_data_is_masked(spark, docs):
    rows = {r.doc_id: r for r in pipeline.personal_data(spark, docs, SF_DIR).collect()}
    assert rows[6].text == "mail [EMAIL] now" and rows[6].n_chars == 16
    assert rows[1].text == words(0, 80) and rows[7].text is None and len(rows) == 9


def test_an_empty_table_goes_through(spark, docs):
    rows = docs.limit(0)
    for _, stage in pipeline.STAGES:
        rows = stage(spark, rows, SF_DIR)
        assert rows.count() == 0


def test_run_equals_its_stages(spark):
    rows = pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    packed = {r.doc_id for r in rows.select("doc_id").collect()}
    step = docs
    for _, stage in pipeline.STAGES[:-1]:
        step = stage(spark, step, SF_DIR)
    assert packed == {r.doc_id for r in step.select("doc_id").collect()}
    used = rows.selectExpr("sequence_id", "offset + length AS until").groupBy("sequence_id").agg({"until": "max"})
    assert max(r[1] for r in used.collect()) <= 4096 and 0 < len(packed) < docs.count()


def test_clashing_columns(spark, docs):
    """Stages leave columns alone that are called like those they make on their way."""
    from pyspark.sql import functions as F

    names = ["toxicity", "removed_lines", "leader_id", "leader_hash", "leader_rows", "text_hash", "component_key", "n_shingles", "spans", "run_id"]
    rows = docs.withColumns({n: F.lit("own") for n in names})
    for _, stage in pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF_DIR)
        assert rows.columns == [*docs.columns, *names]
    assert rows.select(*names).distinct().collect() == [tuple(["own"] * len(names))] and rows.count() > 3
    assert pipeline.best_fit_packing(spark, rows, SF_DIR).count() >= rows.count()
