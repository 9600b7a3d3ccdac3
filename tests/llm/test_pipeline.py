"""The pipeline's stages, each against a plain version on its own input."""

import corpus_pipeline as pipeline
import sentencepiece

from tests.llm import plain
from tests.llm.conftest import SF
from tokenloom.llm.queries import PIECE_MODEL
from tokenloom.plans.staging import staged


def test_stages(spark, edge):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs = staged(documents.unionByName(edge.where("doc_id IS NULL OR doc_id > 2").select(*documents.columns).withColumn("doc_id", edge.doc_id + 10_000)))
    before = docs.toPandas()
    after = []
    for name, stage in pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        after.append(docs.toPandas())
        if name != "sentencepiece":
            assert docs.columns == pipeline.COLUMNS
    language, near, cut, mixed, encoded = after

    known = before[before.text.fillna("").str.contains(r"[^\W\d_]", regex=True)]
    assert len(language) >= 0.98 * len(known) and set(language.doc_id.dropna()) <= set(known.doc_id.dropna())

    want = plain.near_documents([(int(i), t) for i, t in zip(language.doc_id, language.text) if i == i])
    assert sorted(near.doc_id) == sorted(i for i, (_, c) in want.items() if i == c)

    want = plain.without_repeats(list(zip(near.doc_id, near.text)))
    assert dict(zip(cut.doc_id, cut.text)) == {i: rest.decode("utf-8", "ignore") for i, (*_, rest) in want.items()}
    assert (cut.n_chars == cut.text.str.len()).all()

    times = mixed.groupby("doc_id").size()
    assert times.max() <= 3 and set(times.index) <= set(cut.doc_id)
    assert dict(zip(mixed.doc_id, mixed.text)).items() <= dict(zip(cut.doc_id, cut.text)).items()

    processor = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert sorted(map(tuple, encoded.to_numpy().tolist())) == sorted((i, *plain.pieces(processor, t)) for i, t in zip(mixed.doc_id, mixed.text))


def test_run_without_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
