"""The pipeline against a plain Python version of every stage on a small fixture."""

import hashlib
import random

import sentencepiece
from cases import SCHEMA, documents
from test_dedup import near_brute, normal
from test_mixing import filled

import corpus_pipeline
from viaduct.llm.mixing import SEED
from viaduct.llm.queries import vocabulary


def fixture(spark, folder):
    draw = random.Random(12)
    vocabulary_words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(260):
        words = [draw.choice(vocabulary_words) for _ in range(draw.randrange(20, 70))]
        toxic = i % 5 == 0
        if toxic:
            words[3] = words[9] = draw.choice(["rotter", "scoundrel"])
        rows.append([i, " ".join(words)])
        labels.append((i, int(toxic)))
    for i in range(260, 300):  # copies, and copies with one word changed at the end
        rows.append([i, rows[i - 200][1].upper() if i % 2 else rows[i - 200][1] + " tail"])
    rows += [[300, ""], [301, None]]
    docs = documents(spark, [tuple(r) for r in rows])
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr(
        "doc_id", "1 AS quality", "toxic").write.parquet(f"{folder}/labels.parquet")
    return [(i, t, ["s1", "s2", None, ""][k % 4]) for k, (i, t) in enumerate(rows)]


def test_every_stage(spark, tmp_path):
    import hashlib as h
    rows = fixture(spark, str(tmp_path))
    # Toxic words are plain in the fixture, so that the stage has one right answer.
    rows = [r for r in rows if "rotter" not in normal(r[1]).decode() and "scoundrel" not in normal(r[1]).decode()]
    best = {}
    for r in rows:
        best[normal(r[1])] = max(best.get(normal(r[1]), r), r, key=lambda x: x[0])
    rows = list(best.values())
    kept = {i for i, _, _, stays in near_brute([(i, t) for i, t, _ in rows], 5, 80) if stays}
    rows = [r for r in rows if r[0] in kept]
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(normal(text).split())
    target = filled(sizes)
    expected = []
    processor = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    for source in sizes:
        part = int(target[source] - sizes[source] * int(target[source] / sizes[source]) + 0.5)
        members = sorted([r for r in rows if r[2] == source],
                         key=lambda r: (h.md5(f"{SEED}|{r[0]}".encode()).hexdigest(), r[0]))
        for i, text, _ in members:
            words = (text or "").split()
            extra = max(0, min(len(words), part))
            part -= len(words)
            if words:
                copies = [text] * int(target[source] / sizes[source])
                copies += [text] * (extra == len(words)) + [" ".join(words[:extra])] * (0 < extra < len(words))
                for copy in copies:
                    ids = processor.encode(copy)
                    expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                     hashlib.sha256(processor.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(expected)


def test_stages_keep_columns_and_pass_nothing_through(spark, tmp_path):
    nothing = spark.createDataFrame([], SCHEMA).select("doc_id", "text", "lang", "source", "n_chars")
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, str(tmp_path)).columns == nothing.columns, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_only_the_last_output_is_left(spark, tmp_path):
    from pathlib import Path

    fixture(spark, str(tmp_path))
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("llm-pipeline-*"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert [p.name.split("-")[2] for p in set(shared.glob("llm-pipeline-*")) - before] == ["sentencepiece"]
