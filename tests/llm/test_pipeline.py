"""Each stage of the pipeline on what the one before it kept."""

from pyspark.sql import functions as F

import brute
import corpus_pipeline
from test_operators import BASE_TEXT, ITEM, ODD, ROWS
from tallybrook.llm import privacy
from tallybrook.llm.base import stored, table


def test_stages(spark, data):
    docs = table(spark, data, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stored(stage(spark, docs, data), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    stages = [name for name, _ in corpus_pipeline.STAGES]
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in seen.items()}
    texts = {n: dict(d.select("doc_id", "text").rdd.map(tuple).collect()) for n, d in seen.items()}
    # Toxic and bad documents go, good ones stay.
    labels = table(spark, data, "labels").collect()
    good = {r.doc_id for r in labels if r.quality == 1 and not r.toxic}
    toxic = {r.doc_id for r in labels if r.toxic}
    left = ids[stages[1]]
    assert len(good & left) > 0.97 * len(good) and len(toxic & left) < 0.2 * len(toxic)
    near = brute.near_components(sorted(texts[stages[1]].items()), size=5)
    assert ids[stages[2]] == {k for k, v in near.items() if v[2]}
    items = [tuple(r) for r in table(spark, data, "benchmark").select("item_id", "text").collect()]
    hit = brute.contaminated(sorted(texts[stages[2]].items()), items)
    assert ids[stages[3]] == {k for k, v in hit.items() if not v[-1]}
    assert ids[stages[4]] == ids[stages[3]]
    for doc, text in texts[stages[4]].items():
        before = texts[stages[3]][doc]
        assert text == privacy.redact(before, privacy.spans_of(before))
    assert {r.doc_id for r in docs.select("doc_id").collect()} == ids[stages[4]]


def test_odd_rows_and_names(spark, data, tmp_path):
    """Nulls, repeated rows, long texts and clashing names go through the whole chain; nothing is lost but copies."""
    rows = [*ROWS, ROWS[0], ROWS[3], (None, None), (None, BASE_TEXT), (None, "no id and no copy of it"), (None, "no id and no copy of it")]
    docs = spark.createDataFrame([(k, t, None if (k or 0) % 2 else "en", None, None) for k, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({name: F.lit("x") for name in ODD if name not in docs.columns}).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, None, 1), (None, 1, 1), (99, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (None, None), (3, "--")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, str(tmp_path), "documents")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), "odd-stage")
        assert docs.columns == columns and docs.filter("kept <> 'x' or row <> 'x'").count() == 0
        sizes.append(docs.count())
    # Labels of one kind only: all are kept at first.
    unique = {(k, t) for k, (n, root, kept) in brute.near_components(ROWS, 5).items() if kept for t in [dict(ROWS)[k]]}
    assert sizes[0] == len(rows) and sizes[1] == len(unique) + 2
    hit = {k for k, v in brute.contaminated(ROWS, [(1, ITEM)]).items() if v[-1]}
    left = {r.doc_id for r in docs.collect()}
    assert left == {k for k, _ in unique if k not in hit} | {None}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == left and sum(r.piece == 0 for r in packed) == sizes[-1]


def test_empty_table(spark, data, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, data, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
