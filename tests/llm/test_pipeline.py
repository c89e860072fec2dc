"""Every stage of the pipeline against its plain version."""

import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from test_byte_bpe import PATH
from test_decontaminate import brute as leaked_pairs
from test_line_dedup import brute as removed_lines
from test_simhash import brute as groups

from tramline.llm import byte_bpe, common, toxicity

SF_DIR = "/root/testdata/sf0.001"


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "byte_bpe"]
    before = texts(docs)

    docs = corpus_pipeline.materialise(stages["toxicity"](spark, docs, SF_DIR), "t")
    kept = texts(docs)
    labels = common.table(spark, SF_DIR, "labels").filter(common.fold("doc_id", 4) != 2)
    whole = common.table(spark, SF_DIR, "documents")
    model = toxicity.fit(common.labelled_sample(whole, labels, "toxic", toxicity.SAMPLE_ROWS, toxicity.SEED))
    scores = toxicity.Scorer(model).scores([t or "" for t in before.values()])
    assert kept == {i: t for (i, t), s in zip(before.items(), scores) if s < 0.3}
    assert docs.columns == columns and len(kept) < len(before)

    docs = corpus_pipeline.materialise(stages["line_dedup"](spark, docs, SF_DIR), "t")
    gone = removed_lines(sorted(kept.items()))
    wanted = {
        i: t and "\n".join(line for k, line in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in kept.items()
    }
    found = texts(docs)
    # Bands find all of the small table's links.
    assert docs.columns == columns and found.keys() == wanted.keys() and gone
    assert found == wanted
    assert all(r.n_chars == len(r.text or "") for r in docs.collect())

    docs = corpus_pipeline.materialise(stages["simhash_dedup"](spark, docs, SF_DIR), "t")
    first = {i for i, _, c in groups(sorted(wanted.items())) if i == c}
    kept = {i: t for i, t in wanted.items() if i in first}
    assert texts(docs) == kept and docs.columns == columns and len(kept) < len(wanted)

    docs = corpus_pipeline.materialise(stages["decontamination"](spark, docs, SF_DIR), "t")
    items = [(r.item_id, r.text) for r in common.table(spark, SF_DIR, "benchmark").collect()]
    bad = {d for d, *_ in leaked_pairs(sorted(kept.items()), items)}
    kept = {i: t for i, t in kept.items() if i not in bad}
    assert texts(docs) == kept and docs.columns == columns

    found = stages["byte_bpe"](spark, docs, SF_DIR).collect()
    library = byte_bpe.tokenizer(common.file_bytes(PATH), public_tokenizers.PATTERN)
    ids = {i: np.array(library.encode_ordinary(t or ""), "<u4").tobytes() for i, t in kept.items()}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in found} == {
        i: (len(b) // 4, hashlib.sha256(b).hexdigest()) for i, b in ids.items()
    }
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(tuple, found))


def test_empty_documents(spark):
    docs = common.table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), "t")
    assert docs.count() == 0
