import public_tokenizers
import tiktoken
from llm import plain

import corpus_pipeline
from ramparts.llm import bpe, pii, quality
from ramparts.llm.queries import PSEUDONYM_KEY
from ramparts.llm.shared import table


def test_run_against_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cleaned = [(r.doc_id, r.text) for r in quality.clean_documents(docs).collect()]
    first = {}
    for (doc_id, _, component), (_, text) in zip(plain.groups(cleaned), cleaned):
        if doc_id == component:
            first[doc_id] = text
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    clean = [row[0] for row in plain.contamination(list(first.items()), items) if not row[-1]]
    pseudonyms = pii.Pseudonyms(PSEUDONYM_KEY)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {}
    for doc_id in clean:
        text = pseudonyms.replaced(first[doc_id])[0]
        expected[doc_id] = (text, len(text), library.encode_ordinary(text), True)
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == [*docs.columns, "ids", "n_tokens", "decodes"]
    assert {r.doc_id: (r.text, r.n_chars, r.ids, r.decodes) for r in found.collect()} == expected
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "private_values", "encoding",
    ]


def test_rows_of_every_kind(spark, sf_dir, tmp_path):
    """Nulls, empty and long texts, repeated rows and a column with a name that stages use: none is lost or made up."""
    docs = table(spark, sf_dir, "documents")
    prose = next(r.text for r in quality.clean_documents(docs.orderBy("doc_id")).collect() if len(r.text) > 400)
    rows = [
        (1, prose, "en", "s", len(prose), "x"), (1, prose, "en", "s", len(prose), "x"), (2, prose + " Extra.", "en", "s", 0, None),
        (3, None, None, None, None, None), (4, "", "en", "s", 0, "x"), (None, prose, "en", "s", None, "y"),
        (5, "Some words that never end, one after the other. " * 4000, "en", "s", 1, "z"),
    ]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, Fingerprint string"
    spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, sf_dir, "benchmark").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.columns == [*kinds.replace(",", "").split()[::2], "ids", "n_tokens", "decodes"]
    kept = found.collect()
    assert [r.doc_id for r in kept] == [1] and kept[0].decodes and kept[0].Fingerprint == "x"


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "benchmark"):
        table(spark, sf_dir, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
