"""The pipeline against the same stages by hand, on documents with planted cases."""

import random

import public_tokenizers
import sentencepiece

import corpus_pipeline
from test_operators import components_by_hand, dedup_by_hand


def test_pipeline_equals_stages_by_hand(spark, tmp_path):
    rng = random.Random(2)

    def text(n):
        return " ".join("".join(rng.choice(["the", "ing", "er", "and", "on", "st"]) for _ in range(rng.randint(1, 4)))
                        for _ in range(n))
    item = text(30)
    shared = "a line that many documents share"
    rows = [(i, f"{text(60)}\n{shared}\n{text(20)}") for i in range(60)]
    rows += [(100, rows[7][1]), (101, rows[9][1] + " more"), (102, f"{text(20)} {item} {text(9)}"), (103, None),
             (104, "12 34 ..."), (105, shared), (106, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [(i, t) for i, t in rows if any(c.isalpha() for c in t or "")]
    kept = [(i, t) for i, _, _, t in dedup_by_hand(kept)]
    classes = components_by_hand(kept)
    kept = [(i, t) for i, t in kept if classes[i][1] == i and item not in t]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: (t, library.encode(t)) for i, t in kept}

    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == [*corpus_pipeline.COLUMNS, "ids", "decoded"]
    rows = got.collect()
    assert {r.doc_id: (r.text, r.ids) for r in rows} == want and len(rows) == len(want)
    assert all(r.decoded == r.text for r in rows)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "near duplicates", "decontamination", "SentencePiece"]
