"""The pipeline's rows against a plain version of its stages."""

import re

import pytest
from test_text_queries import components, plain_fingerprint

import corpus_pipeline
from tidemark.llm import piece_codec, pii, quality_rules


@pytest.fixture(scope="module")
def result(spark, folder):
    return corpus_pipeline.run(spark, folder).toPandas().set_index("doc_id")


def words(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))


def test_rows_equal_a_plain_run(spark, folder, result):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rules = quality_rules.decision_list(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for doc, text in texts.items():
        n, chars, symbols, dups, repeats, lines = quality_rules.text_statistics(text)
        values = {
            "n_words": n, "mean_word": chars / n if n else 0, "symbol_rate": symbols / n if n else 0,
            "dup_line_rate": dups / lines if lines else 0, "repeat_rate": repeats / n if n else 0,
        }
        rejected = any(all(bool(t.holds(values)) for t in tests) for tests in rules)
        if n >= 50 and 100 * repeats <= 50 * n and not rejected:
            kept[doc] = text
    roots = components({d: plain_fingerprint(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if roots[d] == d}
    grams = set()
    for row in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        w = words(row.text)
        size = min(10, len(w))
        grams |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
    sizes = {len(g) for g in grams}
    clean = {
        d: t for d, t in kept.items()
        if not any(tuple(w[i : i + s]) in grams for w in [words(t)] for s in sizes for i in range(len(w) - s + 1))
    }
    assert set(result.index) == set(clean) and len(clean) < len(kept) < len(texts)
    emails = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for doc, text in clean.items():
        assert not emails.search(result.loc[doc].decoded)
        if not re.search(r"[@+0-9]", text):
            assert result.loc[doc].decoded == text
        else:
            assert result.loc[doc].decoded.count("[EMAIL]") == len(emails.findall(text))


def test_ids_decode_to_the_text(result):
    import public_tokenizers

    coder = piece_codec.codec(public_tokenizers.path("piece_bpe_32k.model"))
    for row in result.itertuples():
        ids = [int(i) for i in row.ids.split(" ")]
        assert len(ids) == row.n_tokens and coder.decode(ids) == row.decoded


def test_stages_keep_the_columns(spark, folder, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string"
    text = " ".join(f"w{n}x" for n in range(70))
    docs = spark.createDataFrame(
        [(1, text + " a@b.cd", "en", "s", 1, "mine", "own"), (2, None, None, None, None, None, None), (1, text + " a@b.cd", "en", "s", 1, "mine", "own")], schema
    )
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert docs.columns == before and docs.first()["kept"] == "mine"
    (row,) = docs.collect()
    assert row.decoded.endswith("[EMAIL]") and pii.BASE[0] == "email"


def test_empty_input(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
    assert docs.count() == 0
