"""The pipeline against its stages done plainly."""

from conftest import SF
from pyspark.sql import functions as F
from test_operators import ALNUM, LOWER, _components

import corpus_pipeline as P
from tintloom.llm import pfor, queries


def test_stages_on_all_that_came_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("more", F.lit("x"))
    kept = P.keep_good(spark, docs, SF)
    assert kept.columns == docs.columns
    kept = spark.createDataFrame(kept.collect(), kept.schema)
    good = {r.doc_id: r.text for r in kept.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert 0 < len(good) < docs.count()
    assert sum(labels.get(d) == 0 for d in good) <= 2

    single = P.keep_one_of_each_group(spark, kept, SF)
    ids = {r.doc_id for r in single.collect()}
    assert single.columns == docs.columns and ids == {d for d, (_, c) in _components(sorted(good.items())).items() if c == d}

    single = spark.createDataFrame(single.collect(), single.schema)
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = ALNUM.findall((r.text or "").translate(LOWER))
        windows |= {" ".join(w[k : k + 10]) for k in range(max(1, len(w) - 9) if w else 0)}
    clean = {d for d in ids if not any(f" {x} " in f" {' '.join(ALNUM.findall((good[d] or '').translate(LOWER)))} " for x in windows)}
    left = P.keep_uncontaminated(spark, single, SF)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == clean

    left = spark.createDataFrame(left.collect(), left.schema)
    mixed = P.mix_sources(spark, left, SF)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= clean

    mixed = spark.createDataFrame(mixed.collect(), mixed.schema)
    tokens = P.write_token_files(spark, mixed, SF).collect()
    assert sorted(r.doc_id for r in tokens) == sorted(r.doc_id for r in mixed.collect())
    lengths, _ = pfor.Encoder(queries.tokenizer_path())([r.text.encode() for r in mixed.collect()])
    assert sum(r.n_tokens for r in tokens) == lengths.sum() and max(r.start + r.n_tokens for r in tokens) == lengths.sum()


def test_run(spark):
    rows = P.run(spark, SF).collect()
    assert rows and sorted(r.start for r in rows)[0] == 0 and [name for name, _ in P.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "mixing", "token_files"]
    assert P.ORACLE_SQL is None


def test_rows_without_an_id_or_text_stay_or_go(spark):
    near = "k l m n o p q r s t u v w x y z".split()
    rows = [(None, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (4, None), (4, None), (None, ""), (5, " ".join(near * 3)), (5, " ".join(near * 3)), (5, "g h i j k")]
    rows += [(None, f"{' '.join(near * 3)} {k}") for k in range(3)] + [(None, "without an id"), (None, "without an id")]
    docs = spark.createDataFrame([(d, t, "en", "s", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, row_0 int")
    kept = P.keep_one_of_each_group(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept.collect()) == sorted([(1, "a b c d e f"), (4, ""), (4, ""), (0, ""), rows[6], rows[8], (0, "without an id")])
    assert P.keep_one_of_each_group(spark, docs.limit(0), SF).count() == 0
    assert P.keep_good(spark, docs, SF).count() == 0 and P.mix_sources(spark, docs.limit(0), SF).count() == 0
