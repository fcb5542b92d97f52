"""The pipeline: each stage's decisions against planted documents."""

import random

import corpus_pipeline
from corpusloom.llm import near_copies


def test_planted_cases(spark, docs, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeghklmnoprstu") for _ in range(rng.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n)) + "."
    clean = [(i, text(120)) for i in range(40)]
    toxic = [(100 + i, f"{text(30)} you stupid idiot. {text(30)}") for i in range(20)]
    copies = [(200 + i, clean[i][1]) for i in range(5)] + [(210 + i, clean[i][1] + " tail") for i in range(5)]
    item = text(40)
    leaks = [(300 + i, f"{text(50)} {item} {text(20)}") for i in range(4)]
    secret = [(400, f"{text(60)} token = 0123456789abcdef0123456789 {text(10)}")]
    rows = clean + toxic + copies + leaks + secret
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(k, 1, int(100 <= k < 200)) for k, _ in clean + toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left, seen = docs(rows), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, left, str(tmp_path))
        made.write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = left.collect()
        if name != "packing":
            assert left.columns == docs(rows).columns
    ids = {name: {r.doc_id for r in own} for name, own in seen.items()}
    assert ids["toxicity"] == {k for k, _ in rows if not 100 <= k < 200}
    assert ids["near_copies"] == {k for k, _ in clean + leaks + secret}
    assert ids["decontamination"] == {k for k, _ in clean + secret} == ids["secrets"] == ids["packing"]
    (own,) = [r for r in seen["secrets"] if r.doc_id == 400]
    assert "[secret]" in own.text and "0123456789abcdef" not in own.text and own.n_chars == len(own.text)
    whole = sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert whole == sorted(tuple(r)[:5] for r in seen["packing"])


def test_no_near_copies_are_left(spark, docs):
    rows = [(i, t) for i, t in enumerate(["a b c d e f g", "a b c d e f g", "x", "x", None, ""])]
    left = near_copies.one_of_each(docs(rows)).collect()
    assert sorted(r.doc_id for r in left) == [0, 2, 4]
