from __future__ import annotations

import corpus_pipeline
from sparvane.llm import queries
from tests.llm.conftest import prose


def test_stages(spark, make, tmp_path):
    bench = prose(40, 1)
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    shared = prose(60, 2)
    texts = [prose(150, k) for k in range(10, 60)]
    texts[1] = texts[0]  # a copy
    texts[3] = texts[2].replace(" the ", " a ", 1)  # nearly
    texts[4] += shared
    texts[5] = prose(80, 900) + shared + prose(80, 901)
    texts[6] += " " + bench
    texts[7] = "### *** $$$ " * 60
    docs = make(texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, str(tmp_path))
        at.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = at
        if name != "pack":
            assert at.columns == docs.columns
    ids = {n: {r.doc_id for r in df.select("doc_id").collect()} for n, df in seen.items()}
    everyone = set(range(50))
    assert ids["quality_filter"] == everyone - {7}
    assert ids["near_duplicates"] == everyone - {7, 1, 3}
    assert ids["repeated_passages"] == ids["near_duplicates"]
    assert shared not in " ".join(r.text for r in seen["repeated_passages"].collect())
    assert ids["benchmark_leaks"] == everyone - {7, 1, 3, 6} == ids["pack"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).drop("sequence_id", "offset", "start", "length", "ids_crc32").distinct().collect())) == sorted(map(tuple, seen["pack"].select("doc_id", "doc_tokens").distinct().collect()))


def test_short_words_are_cut_too(spark, make):
    passage = " ".join(sorted(prose(400, 70).replace(".", "").split(), key=len)[200:251])
    assert len(passage.split()) == 51 and 200 <= len(passage.encode()) < 250
    docs = make([prose(90, 71) + " " + passage + " " + prose(90, 72), prose(90, 73) + " " + passage + " " + prose(90, 74), prose(90, 75)])
    left = [r.text for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()]
    assert len(left) == 3 and not any(passage in t for t in left)


def test_names():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{k}" for k in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5
