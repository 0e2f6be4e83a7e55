import random

from helpers import components, documents, shingles, vocabulary, words
from pyspark.sql import functions as F

import corpus_pipeline


# Names that the operators use inside; each holds 'x' in all rows.
CLASHING = (
    "size", "kept", "copies", "removed_lines", "removed_doc", "quality_stratum", "quality_kept", "quality_measures", "near_key",
    "carried", "row", "c0", "digest", "stratum",
)


def corpus():
    draw, vocab = random.Random(41), vocabulary(41, 3000)
    out = []
    for _ in range(60):
        out.append("\n".join(" ".join(draw.choice(vocab) for _ in range(draw.randint(8, 30))) for _ in range(draw.randint(2, 6))))
    shared = " ".join(vocab[:12])
    out += [t + "\n" + shared for t in out[:10]]
    near = out[5].split(" ")
    near[3] = "changed"
    return [*out, " ".join(near), "too short", None, "", "a b c d e f g h " * 20]


def stages(spark, tmp_path, docs):
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        docs = spark.createDataFrame(made.collect(), made.schema)
        frames.append(docs)
    return frames


def test_stages(spark, tmp_path):
    found = corpus()
    docs = documents(spark, found, sources=[f"s{i % 3}" for i in range(len(found))], extra=CLASHING)
    good, lines, near, mixed, encoded = stages(spark, tmp_path, docs)
    assert all(f.columns == docs.columns for f in (good, lines, near, mixed))

    kept = {r["doc_id"] for r in good.collect()}
    assert kept == set(range(len(found))) - {i for i, t in enumerate(found) if len(words(t)) < 20} - {len(found) - 1}

    left = {r["doc_id"]: r for r in lines.collect()}
    assert all(words(r["text"]) and r["n_chars"] == len(r["text"]) for r in left.values())
    every = [(i, k, frozenset(words(x.lower()))) for i in sorted(kept) for k, x in enumerate(found[i].split("\n"))]
    for i in sorted(kept):
        want = [
            x for k, x in enumerate(found[i].split("\n"))
            if not any((j, m) < (i, k) and 10 * len(s & set(words(x.lower()))) >= 8 * len(s | set(words(x.lower()))) for j, m, s in every)
        ]
        assert (left[i]["text"] if i in left else "") == "\n".join(want)

    order = sorted(left)
    roots = components([shingles(left[i]["text"], 5) for i in order], 80)
    assert {r["doc_id"] for r in near.collect()} == {order[k] for k, c in enumerate(roots) if k == c}

    before = {r["doc_id"]: r for r in near.collect()}
    for r in mixed.collect():
        assert r == before[r["doc_id"]]
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2
    total = sum(len(words(r["text"])) for r in before.values())
    assert abs(sum(len(words(r["text"])) for r in mixed.collect()) - 1.5 * total) <= 3 * 80
    assert {"doc_id", "n_tokens", "token_ids", "decoded_sha256"} <= set(encoded.columns)
    assert encoded.count() == mixed.count() and encoded.filter(F.size("token_ids") != F.col("n_tokens")).count() == 0


def test_run_on_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_of_shared_and_null_ids(spark):
    draw, vocab = random.Random(43), vocabulary(43, 3000)
    a, b, c, d, e = (" ".join(draw.choice(vocab) for _ in range(80)) for _ in range(5))
    rows = [
        (1, a), (4, a + " more"), (4, b),  # the clean text that shares the id of a near copy stays
        (-5, c), (-5, c), (6, c),  # repeated rows are one
        (None, d), (None, d), (None, d + " more"), (None, e), (9, e), (None, None), (None, None),
    ]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows], extra=("kept", "n_shingles"))
    left = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert left.columns == docs.columns
    found = sorted((str(r["doc_id"]), r["text"] or "") for r in left.collect())
    ds = [t for i, t in found if i == "None" and t]
    assert len(ds) == 1 and ds[0] in (d, d + " more")
    assert found == sorted([("1", a), ("4", b), ("-5", c), ("9", e), ("None", ds[0]), ("None", ""), ("None", "")])
