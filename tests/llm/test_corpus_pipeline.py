"""The pipeline's stages against plain versions on small documents, and the registered queries' schemas."""

import hashlib
import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(1)
    root = tmp_path_factory.mktemp("corpus")
    rows, labels = [], []
    for k in range(400):
        words = [f"w{rnd.randrange(500)}" for _ in range(rnd.randint(30, 80))]
        toxic = int(k % 6 == 0)
        for _ in range(4 * toxic):
            words[rnd.randrange(len(words))] = rnd.choice(["slur", "vekan"])
        rows.append((k, " ".join(words), "en", f"s{k % 4}", 0))
        labels.append((k, 1, toxic))
    rows += [(1000 + k, rows[k][1], "en", "s1", 0) for k in range(1, 60) if k % 6]
    rows += [(2000, None, None, None, None), (2001, "", "en", "s1", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root), rows, labels


def test_stages(spark, corpus):
    import corpus_pipeline

    root, rows, labels = corpus
    docs = spark.read.parquet(f"{root}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "mixing", "byte_bpe"]
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, root)
    assert clean.columns == docs.columns
    kept = {r["doc_id"] for r in clean.collect()}
    toxic = {k for k, _, t in labels if t}
    assert len(kept & toxic) <= 3 and len({r[0] for r in rows} - toxic - kept) <= 3
    single = stage["simhash_near_dedup"](spark, clean, root)
    left = {r["doc_id"] for r in single.collect()}
    assert single.columns == docs.columns and not {k for k in left if 1000 <= k < 2000} and kept - left <= set(range(1000, 2002))
    mixed = stage["mixing"](spark, single, root)
    assert mixed.columns == docs.columns
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= left and max(times.values()) <= 2
    encoded = stage["byte_bpe"](spark, mixed, root).collect()
    text = {r[0]: r[1] or "" for r in rows}
    assert len(encoded) == sum(times.values())
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() and len(r["ids"]) == 4 * r["n_tokens"] for r in encoded)
    ran = corpus_pipeline.run(spark, root).collect()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in ran) == sorted((r["doc_id"], r["ids_sha256"]) for r in encoded)


def test_mix_equals_its_sql(spark, corpus):
    import duckdb

    from tidegate.llm import mixing, registry

    root, _, _ = corpus
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{root}/documents.parquet/*.parquet'")
    cursor = con.execute(registry.oracle_sql()["op7_mix"])
    names = [c[0] for c in cursor.description]
    theirs = sorted(tuple(r[names.index(c)] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in cursor.fetchall())
    assert sorted(tuple(r) for r in mixing.op7_mix(spark, root).collect()) == theirs


def test_empty_tables_and_other_columns(spark, corpus, tmp_path):
    import corpus_pipeline
    from pyspark.sql import functions as F

    for name, columns in (("documents", DOCS), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    root = corpus[0]
    docs = spark.read.parquet(f"{root}/documents.parquet").where("doc_id < 40 OR doc_id >= 2000")
    wide = docs.withColumn("_times", F.lit(1)).withColumn("own", F.lit("x")).withColumn("times", F.lit(2)).withColumn("file", F.lit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wide = stage(spark, wide, root)
        assert wide.columns == [*docs.columns, "_times", "own", "times", "file"], name
    assert wide.count() > 0
