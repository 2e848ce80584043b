"""The registered text queries against SQL, public libraries or brute force on whole tables."""

import hashlib
import html
import random
import re
import textwrap

import numpy as np
import pandas as pd
import pytest
import xxhash
from oracle import compare, connect

import __spark_entry__ as entry
from tidemark.llm import quality_rules
from tidemark.llm.license_scan import known_rows
from tidemark.llm.queries import QUERIES, SQL


class Query:
    def __init__(self, name):
        self.run, self.sql = QUERIES[name], SQL[name]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, folder, name):
    assert compare(spark, connect(folder), Query(name), folder) is None


IBANS = [
    "ES91 2100 0418 4502 0005 1332 EUR", "AT61 1904 3002 3457 3201 A", "BE68539007547034 BANK", "DE89 3704 0044 0532 0130 00 DE89 3704 0044 0532 0130 00",
    "xDE89370400440532013000", "DE89370400440532013000x", "_DE89370400440532013000_", "ZZ68 5390 0754 7034", "ZZ685390075470341", "QQ00 ABCD EFGH DE89 3704 0044 0532 0130 00",
    "GB82 WEST 1234 5698 7654 32.", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S", "AA11 DE89 3704 0044 0532 0130 00", "DE89", "GB82WEST 12345698 765432 and FR14 2004 1010 0505 0001 3M02 606!",
    "account 123-45-6789 ssn", "1123-45-6789 ssn", "123-45-67890 ssn", None, "",
]
KEYS = ["q8Zr2Lw9Xc4Vb7Nm1Kj5Hg3Fd6Sa0PoIuYt", "3f9a1c7e5b2d8064af13", "Zk3/9+aQ8_xW=7Lm2-PoR5tYu1Ib", "A1b2C3d4E5f6G7h8I9j0K1l2"]
SECRETS = [
    *KEYS, *[f"sample-app/{k}" for k in KEYS], *[f"your_key={k}" for k in KEYS], *[f"{k}Example{k}" for k in KEYS], *[f"{k}xxxxxxx" for k in KEYS],
    "dummy" + KEYS[0] + "0123456789" + KEYS[2] + "00000000", "123e4567-e89b-12d3-a456-426614174000", f"id=123e4567-e89b-12d3-a456-426614174000 token={KEYS[3]}", None, "",
]


def license_documents():
    """Whole licences at several widths, parts of them, and lines that are statements or only look like one."""
    rng, rows = random.Random(6), []
    heads = ["", "Copyright (c) 2020 Some One", "# Copyright Some One", "Copyright Notice", "copyright holders of this", "(C) Acme Inc", "© 2020", "All rights reserved."]
    known = dict(known_rows())
    for name, text in sorted(known.items()):
        rows += [text, f"{rng.choice(heads)}\n{text}", text[: len(text) // 2]]
        for width in (60, 80):
            rows.append("\n \n".join(textwrap.fill(part, width) for part in re.split(r"\n\s*\n", text)))
        parts = re.split(r"\n\s*\n", text)
        rows += ["Some words.\n\n" + "\n \r\n".join(rng.sample(parts, min(3, len(parts)))) + "\n\nMore words\non lines", "\n".join(f" * {x}" for x in text.split("\n")[:90])]
    return rows + heads + ["Sub\nlicense", "#\n#\n", "\n\n", None, ""]


@pytest.mark.parametrize(
    "name, texts, found", [("op5_pii", IBANS, "spans <> ''"), ("op2_secret_scan", SECRETS, "spans <> ''"), ("op4_license_scan", license_documents(), "n_lines > 0")]
)
def test_sql_knows_what_the_operator_knows(spark, tmp_path, name, texts, found):
    """Texts that the given tables lack, alone and between others."""
    rng = random.Random(4)
    rows = texts + [" ".join(rng.choice(texts) or "" for _ in range(4)) for _ in range(60)] + [f"é{t}🙂 {t}" for t in texts]
    docs = pd.DataFrame({"doc_id": range(len(rows)), "text": rows})
    docs.to_parquet(tmp_path / "documents.parquet")
    assert QUERIES[name](spark, str(tmp_path)).filter(found).count() > 20
    assert compare(spark, connect(str(tmp_path)), Query(name), str(tmp_path)) is None


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").toPandas().set_index("doc_id")


def rows_of(spark, folder, name, key="doc_id"):
    return QUERIES[name](spark, folder).toPandas().set_index(key)


def test_quality_statistics_and_verdicts(spark, folder, docs):
    got = rows_of(spark, folder, "op1_quality_rules")
    assert len(got) == len(docs)
    for doc, text in docs.text.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        many = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else None
        row = got.loc[doc]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        if many is not None:
            hit = {j for i, w in enumerate(windows) if w in many for j in range(i, i + 3)}
            assert row.n_repeat_words == len(hit)
        assert row.base_failed == (len(words) < 50 or 100 * row.n_repeat_words > 50 * len(words))
        assert not (row.base_failed and row.kept)


def test_quality_rules_hold_on_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = rows_of(spark, folder, "op1_quality_rules")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")
    both = got.join(labels.dropna(subset=["quality"]), how="inner")
    judged = both[~both.base_failed]
    assert (judged.kept == (judged.quality == 1)).mean() > 0.98


def test_quality_rules_hold_on_labels_they_have_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    seen = quality_rules.judge(docs, labels.filter("doc_id % 2 = 0"), keep=["doc_id"])
    rest = seen.filter("not base_failed").join(labels.filter("doc_id % 2 = 1 AND quality IS NOT NULL"), "doc_id")
    n, right = rest.selectExpr("count(*)", "count_if(kept = (quality = 1))").first()
    assert n > 1000 and right > 0.98 * n


def test_sentencepiece_against_the_library(spark, folder, docs):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows_of(spark, folder, "op6_sentencepiece")
    for doc, text in docs.text.items():
        ids = library.encode(text or "", add_eos=True)
        row = got.loc[doc]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id reachable over at most two differing bits, by comparing all."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    values = np.array([prints[i] for i in ids], dtype=np.uint64)
    for n, i in enumerate(ids):
        for m in np.flatnonzero(np.bitwise_count(values ^ values[n]) <= 2):
            a, b = find(i), find(ids[m])
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_against_all_pairs(spark, folder, docs):
    got = rows_of(spark, folder, "op7_simhash")
    prints = {doc: plain_fingerprint(text) for doc, text in docs.text.items()}
    roots = components(prints)
    assert {d: f"{p:016x}" for d, p in prints.items()} == got.fingerprint.to_dict()
    assert roots == got.component_id.to_dict()


def test_html_against_the_article_element(spark, folder):
    got = rows_of(spark, folder, "op9_html_extraction", "page_id")
    pages = spark.read.parquet(f"{folder}/pages.parquet").toPandas().set_index("page_id")
    for page, text in pages.html.items():
        article = re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*?)</article>", text, re.S)[1])
        assert got.loc[page].text == " ".join(html.unescape(article).split())
        assert got.loc[page].n_chars == len(got.loc[page].text)


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = rows_of(spark, folder, "op10_toxicity")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id")
    held = got[got.held_out].join(labels, how="inner")
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.01
    assert got.score.between(0, 1).all()
    pairs = (toxic.score.to_numpy()[:, None] > clean.score.to_numpy()[None, :]).mean()
    assert pairs > 0.93
