"""The corpus pipeline: its stages, and planted cases through all of them."""

import numpy as np

import corpus_pipeline

from .conftest import docs_frame, words


def planted(spark, folder):
    rows, labels = [], []
    for i in range(300):
        w = words(90, 2000 + i, "abcdefghijklmnop")
        if i % 5 == 0:
            w[40] = ("zyzzt", "zyzzta", "zyzztor")[i // 5 % 3]
        text = ", ".join(" ".join(w[a : a + 9]) for a in range(0, 90, 9)) + "."
        rows.append((i, text, "s"))
        labels.append((i, 1, int(i % 5 == 0)))
    for i in range(30):  # junk
        rows.append((300 + i, " ".join(x + "%%%" for x in words(80, 4000 + i)), "s"))
    rows.append((400, rows[1][1], "s"))  # an exact copy
    rows.append((401, rows[2][1].replace(",", "", 1), "s"))  # a near copy
    passage = " ".join(words(60, 9999, "abcdefghijklmnop"))
    for i in (402, 403):  # a passage in two documents
        rows.append((i, " ".join([rows[i - 300][1].replace("a", "q"), passage, words(1, i)[0]]) + ".", "s"))
    docs_frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return passage


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    passage = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.schema.names == docs.schema.names
        out.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    toxic, poor, near, passages, packed = kept
    clean = {i for i in range(300) if i % 5}
    assert len(toxic & set(range(0, 300, 5))) <= 3 and len(clean - toxic) <= 3
    assert len(poor & set(range(300, 330))) <= 2 and len((clean & toxic) - poor) <= 3
    assert not {400, 401} & near and (clean & poor) <= near
    assert near == passages == packed
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/stage3").collect()}
    assert [passage in texts[i] for i in (402, 403) if i in texts] == [True, False]
    total = spark.read.parquet(f"{folder}/stage4").groupBy("sequence_id").sum("length").collect()
    assert sorted(r[1] for r in total)[1:] == [2048] * (len(total) - 1)


def test_run(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    got = corpus_pipeline.run(spark, folder).collect()
    assert got and len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert np.isclose(sum(r["length"] for r in got), sum({r["doc_id"]: r["doc_tokens"] for r in got}.values()))
