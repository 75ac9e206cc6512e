"""Scores of hand-made models against slow loops, stages of the pipeline on odd tables, and the spread of shards."""

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import line_crf, sharding, toxicity

pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, uid long, keep_id string, head string"
TEXTS = [None, "", " \n", "one", "One two", "a b c\nd e f g\n\nA B C!!! 12 %\na b c", "word " * 300, "x" * 4000, "naïve, rude; RUDE rude-rude", "rude\nrude\nrude\nkind"]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, 7, 9, "x", "y") for i, t in rows], DOCS)


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def test_convolutions_by_definition(spark):
    rnd = np.random.default_rng(4)
    filters = [rnd.normal(size=(w, toxicity.DIM, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS]
    n = len(filters) * toxicity.FILTERS
    model = toxicity.Model(rnd.normal(0, 0.3, (toxicity.FEATURES, toxicity.BUCKETS, toxicity.DIM)).astype(np.float32), filters, rnd.normal(size=n).astype(np.float32), rnd.normal(size=n + 1).astype(np.float32), shift=0.2, slope=0.3, thresholds={"en": 0.4})
    wanted = []
    for words in toxicity.features(pa.array(TEXTS)):
        words = np.frombuffer(words, np.uint16).reshape(-1, toxicity.FEATURES)
        vectors = [sum(model.embedding[f, b].astype(float) for f, b in enumerate(w)) for w in words]
        total = float(model.out[-1])
        for w, weight in enumerate(filters):
            for f in range(toxicity.FILTERS):
                k = w * toxicity.FILTERS + f
                windows = [float(model.bias[k]) + sum(float(vectors[i + j] @ weight[j, :, f]) for j in range(len(weight))) for i in range(len(vectors) - len(weight) + 1)]
                total += max([0.0, *windows]) * float(model.out[k])
        wanted.append(float(sigmoid(0.3 * total + 0.2)))
    rows = [*enumerate(TEXTS), (None, TEXTS[3]), (3, TEXTS[3]), (3, TEXTS[5])]
    wanted += [wanted[3], wanted[3], wanted[5]]
    found = toxicity.scored(docs_of(spark, rows), model).collect()
    assert np.allclose(sorted(r["score"] for r in found), sorted(wanted), atol=1e-4)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (3, None)}
    for i, r in by_id.items():
        assert abs(r["score"] - wanted[i]) < 1e-4 and r["predicted"] == int(r["score"] >= 0.5) and r["rejected"] == (r["score"] >= 0.4)
    assert len(set(wanted)) > 5
    kept = toxicity.clean(docs_of(spark, rows), model)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for (i, _), s in zip(rows, wanted) if s < 0.4)


def test_line_fields_by_definition(spark):
    """Every labelling of every document is enumerated."""
    rnd = np.random.default_rng(7)
    model = line_crf.Model(rnd.normal(size=3 * line_crf.WIDTH), rnd.normal(size=(2, 2)), slope=1.3, shift=-0.1)
    wanted = []
    for blob in line_crf.features(pa.array(TEXTS)):
        bits, size = line_crf.unpacked(blob)
        n = len(size)
        if not n:
            wanted.append(None)
            continue
        own = line_crf.with_neighbours(bits, np.array([0, n])).astype(float) @ model.weights
        total, good = 0.0, np.zeros(n)
        for y in product((0, 1), repeat=n):
            weight = np.exp(sum(own[i] * v for i, v in enumerate(y)) + sum(model.transitions[a, b] for a, b in zip(y, y[1:])))
            total += weight
            good += weight * np.array(y)
        share = float(good / total @ size / size.sum())
        wanted.append(float(sigmoid(1.3 * np.log(share / (1 - share)) - 0.1)))
    found = {r["doc_id"]: r for r in line_crf.scored(docs_of(spark, list(enumerate(TEXTS))), model).collect()}
    empty = {found[i]["score"] for i, s in enumerate(wanted) if s is None}
    assert [i for i, s in enumerate(wanted) if s is None] == [0, 1, 2] and len(empty) == 1 and 0 <= empty.pop() <= 1
    for i, s in enumerate(wanted):
        if s is not None:
            assert abs(found[i]["score"] - s) < 1e-6 and found[i]["predicted"] == int(s >= 0.3)
            assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_shards_are_even(spark):
    """Bytes of shards differ by next to nothing although half of the rows are copies of few texts and groups tie in size."""
    rnd = random.Random(6)
    rows = [(i, "x" * rnd.randint(1, 3000) + str(i)) for i in range(600)] + [(1000 + i, f"copy {i % 60} " * 9) for i in range(600)]
    found = sharding.shard(docs_of(spark, rows), 8).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    assert len(found) == 8 and max(r["bytes"] for r in found) - min(r["bytes"] for r in found) <= 16
    home = {}
    for r in sharding.shard(docs_of(spark, rows), 8).collect():
        assert home.setdefault((r["text_crc32"], r["size"]), r["shard"]) == r["shard"]


def test_stages_of_odd_tables(spark, tmp_path):
    """No rows give no rows; copies and near copies leave the row with the smallest id, whatever other columns there are."""
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    nothing = docs_of(spark, [(1, "a")]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, nothing, str(tmp_path))
        assert found.count() == 0, name
        assert name == "packing" or found.columns == nothing.columns, name
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(7, base), (3, base.replace(" ", "\n ")), (9, base + " more"), (4, None), (5, ""), (5, ""), (None, base), (8, "other words here and there again"), (None, None)]
    once = dict(corpus_pipeline.STAGES)["exact dedup"](spark, docs_of(spark, rows), str(tmp_path))
    assert once.columns == nothing.columns and sorted((r["doc_id"] for r in once.collect())) == [3, 4, 8, 9]
    near = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs_of(spark, rows), str(tmp_path))
    worded = [r["doc_id"] for r in near.where("trim(text) <> ''").collect()]
    assert near.columns == nothing.columns and sorted(worded) == [3, 8]
    assert {(r["source"], r["score"], r["head"]) for r in near.collect()} == {("s", 0.5, "y")}
