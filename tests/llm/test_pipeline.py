import hashlib
import random

import corpus_pipeline
from hearth.llm import toxicity
from pyspark.sql import functions as F


def test_stages_keep_clean_documents(spark, tmp_path):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = text(30)
    docs = [(i, text(60)) for i in range(40)]
    docs += [(100 + i, text(20) + " idiot " + text(20)) for i in range(30)]
    docs += [(200, docs[0][1]), (201, docs[1][1] + " end"), (202, text(20) + " " + item), (203, text(30) + " password=hunter22hunter " + text(5)), (204, None), (205, "")]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], schema)
    folder = str(tmp_path)
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, int(100 <= i < 130)) for i, _ in docs if i < 130]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    left, kept = table, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, folder)
        assert out.columns == table.columns
        out.write.parquet(f"{folder}/{name}")
        left = spark.read.parquet(f"{folder}/{name}")
        kept[name] = {r.doc_id: r.text for r in left.collect()}
    clean = {i for i, _ in docs if i < 100 or i >= 200}
    assert set(kept["toxicity"]) == clean
    assert set(kept["near_duplicates"]) == clean - {200, 201}
    assert set(kept["decontamination"]) == clean - {200, 201, 202}
    assert "hunter22" not in kept["secrets"][203] and kept["secrets"][204] is None
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(final) == clean - {200, 201, 202}
    for i, t in kept["secrets"].items():
        assert final[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_empty_table_stays_empty(spark):
    folder = "/root/testdata/sf0.001"
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0).withColumn("hash", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, folder).count() == 0, name
    assert toxicity.fit(none.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")).scale == 0
