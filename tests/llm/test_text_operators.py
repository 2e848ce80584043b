"""Edge cases of the text operators on small fixtures."""

import os
import random
import re
import textwrap
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    html_text,
    license_scan,
    pii,
    piece_codec,
    quality_rules,
    secret_scan,
    simhash,
    substring_dedup,
    toxicity,
)
from tidemark.llm.common import whole_groups
from tidemark.llm.spans import listed, with_places

SCHEMA = "doc_id long, text string, seed long, score string, key string, n_words string, start int"


def table(spark, *rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, "s", "k", "w", 0) for i, t in rows], SCHEMA)


LONG = " ".join(f"word{n % 977}" for n in range(20_000))
ODD = [(1, "plain words here"), (None, "no id"), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (5, LONG), (6, "x" * 50_000), (6, "é🙂 ſ")]


# -- places -----------------------------------------------------------------------------------


@pytest.mark.parametrize("pattern", [r"[0-9]+", r"a[bc]", r"é+"])
def test_places_match_a_plain_search(spark, pattern):
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1c é🙂2") for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["1 " * 2000, "", "ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for row in with_places(df, "text", "found", pattern).collect():
        expected = [(m.start(), m.end(), m[0]) for m in re.finditer(pattern, row.text)]
        assert [(f.start, f.end, f.match) for f in row.found] == expected


# -- secrets ----------------------------------------------------------------------------------


def secrets(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = secret_scan.find_secrets(df).select("i", listed(F.col("base_spans")).alias("b"), listed(F.col("spans")).alias("s"))
    return [(r.b, r.s) for r in found.sort("i").collect()]


def test_secrets_by_kind(spark):
    got = secrets(
        spark, "password=abcdef", "password=abcde", 'API_KEY : "Zz9+/aQ8"', "xxAKIA" + "A1" * 8, "0" * 23, "a" * 24, None,
        "secret: token: abcdefgh",
    )
    assert [b for b, _ in got] == ["assign:0:15", "", "assign:0:19", "access:2:22", "", "hex:0:24", "", ""]


def test_entropy_windows_are_those_of_a_full_count(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    runs = ["".join(rng.choice(letters[: rng.choice((4, 16, 64))]) for _ in range(rng.randrange(20, 70))) + "a1" for _ in range(80)]
    runs += [runs[n] + rng.choice(["Example", "0123456789", "your_", "xxxxxxx"]) + runs[n + 1] for n in range(40)]
    runs += ["sample-app/" + runs[3], "your_key=" + runs[4], "dummy" + runs[5] + "dummy" + runs[6] + "dummy"]
    for run, (_, spans) in zip(runs, secrets(spark, *runs)):
        limit = next(t for _, p, t in secret_scan.CLASSES if re.search(p, run))
        allowed = [m.span() for m in re.finditer("|".join(f"(?:{a.removeprefix('(?i)')})" for a in secret_scan.ALLOWED), run, re.I)]
        above = []
        for at in range(len(run) - 19):
            if any(a < at + 20 and at < b for a, b in allowed):
                continue
            counts = np.array([run[at : at + 20].count(c) for c in set(run[at : at + 20])]) / 20
            if round(float(-(counts * np.log2(counts)).sum()), 9) >= limit:
                above.append(at)
        # One span for each part between allowed pieces.
        cuts = [b for _, b in allowed]
        groups = {}
        for at in above:
            groups.setdefault(sum(at >= c for c in cuts), []).append(at)
        expected = [f"entropy:{g[0]}:{g[-1] + 20}" for g in groups.values()]
        assert [s for s in spans.split(",") if s.startswith("entropy")] == expected, run


def test_allow_list_spares_method_spans_only(spark):
    name = "A1b2C3d4exampleE5f6G7h8I9"
    (base, spans), = secrets(spark, f"token={name}")
    assert base == spans and base.startswith("assign")


def test_masking(spark):
    df = secret_scan.find_secrets(spark.createDataFrame([("é token=abcdefgh é",), ("none",)], "text string"))
    assert [r[0] for r in df.select(secret_scan.mask(F.col("text"), F.col("spans"))).collect()] == ["é " + "*" * 14 + " é", "none"]


# -- personal data ----------------------------------------------------------------------------


def personal(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = pii.find_personal(df).withColumn("red", pii.redact(F.col("text"), F.col("spans")))
    return [(listed_, red) for listed_, red in [(r.l, r.red) for r in found.select("i", listed(F.col("spans")).alias("l"), "red").sort("i").collect()]]


def test_personal_data_by_kind(spark):
    got = personal(
        spark, "a.b@c.de", "a@b", "1.2.3.4.5", "256.1.1.1", "4111 1111 1111 1111", "4111 1111 1111 1112", "+1 (555) 123-4567",
        "+1 2", "DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "ssn 123-45-6789", "code 123-45-6789", None, "",
    )
    assert [s for s, _ in got] == [
        "email:0:8", "", "ip:0:7", "", "card:0:19", "", "phone:0:17", "", "iban:0:27", "", "ssn:4:15", "", "", "",
    ]
    assert got[0][1] == "[EMAIL]" and got[12][1] is None and got[13][1] == ""


def test_account_numbers_before_upper_case_words(spark):
    """The length by country ends an account number, whatever follows it."""
    numbers = {
        "ES91 2100 0418 4502 0005 1332": " EUR", "AT61 1904 3002 3457 3201": " A", "BE68539007547034": " BANK",
        "BE68 5390 0754 7034": " KBC 12", "NO93 8601 1117 947": " NOK", "GB29 NWBK 6016 1331 9268 19": " X",
        "LC14BOSL123456789012345678901234": "", "LU28 0019 4006 4475 0000": " DE89 3704 0044 0532 0130 00",
    }
    got = personal(spark, *[f"to {number}{rest}" for number, rest in numbers.items()], "ES91 2100 0418 4502 0005 1332X", "ES92 2100 0418 4502 0005 1332 EUR")
    for (spans, red), (number, rest) in zip(got, numbers.items()):
        assert spans.split(",")[0] == f"iban:3:{3 + len(number)}"
        assert red == "to [IBAN]" + (" [IBAN]" if rest.startswith(" DE") else rest)
    assert [spans for spans, _ in got[-2:]] == ["", ""]
    assert sum(len(c.split()) for c in pii.IBAN_LENGTHS.values()) == len({c for cs in pii.IBAN_LENGTHS.values() for c in cs.split()})


def test_personal_data_in_very_long_runs(spark):
    started = time.time()
    got = personal(spark, "1 2 " * 20_000, "a@" + "b." * 20_000 + "c", "9" * 60_000, "z" * 60_000 + " x@y.zz")
    assert got[0][0] == got[2][0] == "" and got[1][0] == "email:0:40003" and got[3][0] == "email:60001:60007"
    assert time.time() - started < 60


# -- decontamination --------------------------------------------------------------------------

PASSAGE = "Alpha beta, gamma delta. Epsilon zeta eta theta iota kappa lambda"


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, PASSAGE), (2, "Omega Psi"), (None, PASSAGE), (3, None), (4, "")], "item_id long, text string")
    docs = table(spark, *ODD, (10, f"x {PASSAGE.upper()} y"), (11, "the omega-psi"), (12, "alpha beta gamma delta"))
    rows = decontaminate.contamination(docs, bench).collect()
    assert len(rows) == docs.count()
    got = {r.id: (r.n_words, r.n_hit, r["items"]) for r in rows}
    assert got[10] == (13, 11, ["", "1"]) and got[11] == (3, 2, ["2"]) and got[12] == (4, 0, [])
    assert got[2] == (0, 0, []) and got[5][0] == 20_000
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    cleaned = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench).collect()}
    assert cleaned[11] == "the -" and cleaned[12] == "alpha beta gamma delta" and cleaned[2] is None


@pytest.mark.parametrize("bounds", [{"BROADCAST_BYTES": 0}, {"PROBED": 0}, {"BROADCAST_BYTES": 0, "PROBED": 0}, {"LISTED": 0}])
def test_decontamination_beyond_the_bounds_is_the_same(spark, folder, monkeypatch, bounds):
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    docs, bench = docs.union(docs.limit(30)), bench.union(spark.createDataFrame([(None, "the of"), (900, "the")], bench.schema))

    def found():
        rows = decontaminate.contamination(docs, bench).select("id", "key", "n_words", "n_hit", F.array_join("items", ",").alias("items"))
        rows = sorted(map(tuple, rows.collect()))
        kept = sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect())
        assert kept == sorted(r[0] for r in rows if r[3] == 0)
        return rows

    usual = found()
    assert sum(r[3] > 0 for r in usual) > 20
    for name, bound in bounds.items():
        monkeypatch.setattr(decontaminate, name, bound)
    assert usual == found()


def test_dropping_shuffles_no_text(spark, folder):
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.drop_contaminated(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_only_windows_in_the_set_are_spelt(spark):
    """A window whose ends are known but whose middle is not never becomes text."""
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    near = PASSAGE.replace("gamma", "other")
    docs = table(spark, (1, f"{PASSAGE} {near} {PASSAGE}"), (2, near), (3, "kappa " * 3000 + "alpha " * 3000))
    rows = decontaminate.GramSet(bench, "item_id", "text", 10).spelt(docs, "doc_id", "text").collect()
    assert {r.id: len(r.spelt) for r in rows} == {1: 4, 2: 0, 3: 0}


def test_empty_benchmark_hits_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(table(spark, *ODD), bench).filter("n_hit > 0").count() == 0


# -- licences ---------------------------------------------------------------------------------


def test_license_forms(spark):
    mit = next(t for n, t in license_scan.KNOWN if n == "MIT" and len(t) > 100)
    docs = table(
        spark, *ODD, (20, "Copyright (c) 2020 Someone\n" + mit.upper().replace(",", " ,")),
        (21, "Text.\nReleased under the MIT Licence!\nreleased  under the mit license\nMore."), (22, "MIT"),
    )
    rows = license_scan.find_licenses(docs, license_scan.known_texts(spark)).collect()
    got = {r.id: r for r in rows}
    assert len(rows) == docs.count() and got[20].license == "MIT"
    assert got[21].license is None and got[21].n_lines == 2 and got[21].line_licenses == ["MIT"]
    assert got[22].license is None and got[2].digest is None


def test_documents_are_brought_to_their_form_once(spark, folder, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.union(docs.limit(20))
    usual = license_scan.find_licenses(docs, license_scan.known_texts(spark))
    assert usual._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2  # one for each side of the union
    monkeypatch.setattr(license_scan, "BROADCAST_BYTES", 0)
    by_shuffle = license_scan.find_licenses(docs, license_scan.known_texts(spark))
    found = [sorted((tuple(r) for r in d.collect()), key=repr) for d in (usual, by_shuffle)]
    assert found[0] == found[1] and len(found[0]) == docs.count()


def test_licenses_at_any_width(spark):
    """A line of prose that begins with 'copyright' or '(c)' is no copyright statement."""
    statements = ["", "Copyright (c) 2020 Some One", "(c) 2020 Some One", "© Some One", "COPYRIGHT 2019, 2020 SOME ONE", "Copyright by Some One",
                  "Copyright [yyyy] [name of copyright owner]", "Copyright Some One, Inc. and others", "(C) Some One", " * Copyright: 2020 Some One"]
    rows, expected = [], []
    for number, (name, text) in enumerate(license_scan.KNOWN):
        for width in (30, 45, 60, 68, 72, 76, 80, 100, 1000):
            for head in statements if len(text) > 100 and width in (68, 72) else statements[:1]:
                wrapped = "\n\n".join(textwrap.fill(part, width) for part in text.split("\n\n"))
                rows.append((len(rows), f"{head}\nAll rights reserved.\n{wrapped}"))
                expected.append(name)
    isc = next(t for n, t in license_scan.KNOWN if n == "ISC" and len(t) > 100)
    rows.append((len(rows), isc.replace("above copyright", "above\ncopyright").replace("OF THIS SOFTWARE", "OF\nTHIS SOFTWARE")))
    rows.append((len(rows), next(t for n, t in license_scan.KNOWN if n == "MIT" and len(t) > 100).replace("AUTHORS OR COPYRIGHT", "AUTHORS OR\nCOPYRIGHT")))
    found = license_scan.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), license_scan.known_texts(spark))
    got = {r.id: r.license for r in found.collect()}
    assert [got[n] for n in range(len(rows))] == expected + ["ISC", "MIT"]


APACHE = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
int x;"""


def test_full_license_texts_and_notices(spark):
    folder = os.path.join(os.path.dirname(license_scan.__file__), "licenses")
    rows, expected = [], []
    for file in sorted(os.listdir(folder)):
        text = open(os.path.join(folder, file), encoding="utf-8").read()
        for form in (text, "Copyright 2024 Some One\n\n" + text.replace("\n", "\r\n"), text.upper()):
            rows.append((len(rows), form))
            expected.append(file.removesuffix(".txt").split("__")[0])
    names = set(expected)
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"} <= names
    mit = next(t for n, t in license_scan.KNOWN if n == "MIT" and len(t) > 100)
    inside = "Some words.\n\n" + "\n\n".join(textwrap.fill(p, 70) for p in mit.split("\n\n")) + "\n\nMore words."
    rows += [(-1, APACHE), (-2, inside), (-3, mit.partition("\n\n")[2]), (-4, APACHE.replace("may not", "may"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r for r in license_scan.find_licenses(docs, license_scan.known_texts(spark)).collect()}
    assert [got[n].license for n in range(len(expected))] == expected
    assert got[-1].line_licenses == ["Apache-2.0"] and got[-1].n_lines == 3
    assert got[-2].license is None and got[-2].line_licenses == ["MIT"] and got[-2].n_lines > 10
    assert got[-3].license == "MIT" and got[-4].n_lines == 1


# -- SentencePiece ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codecs():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.codec(path), sentencepiece.SentencePieceProcessor(model_file=path), path


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="ab the in\n ▁é.,-=1🙂\x00", max_size=60)))
def test_codec_equals_the_library(codecs, text):
    own, library, _ = codecs
    ids = library.encode(text, add_eos=True)
    assert own.encode(text) == ids and own.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 4_000, "ab" * 9_000, "\n" * 500, "é" * 999 + " " * 40 + "x"])
def test_codec_on_long_runs(codecs, text):
    own, library, _ = codecs
    assert own.encode(text) == library.encode(text, add_eos=True)


@pytest.mark.parametrize("bound, most", [("KEPT_STRETCHES", 3), ("KEPT_CHARACTERS", 40), ("LONGEST_KEPT", 4)])
def test_codec_starts_its_table_anew(codecs, monkeypatch, bound, most):
    library, path = codecs[1:]
    own = piece_codec.PieceCodec(path)
    monkeypatch.setattr(piece_codec, bound, most)
    text = "one two three four five six seven one two"
    for _ in range(2):
        assert own.encode(text) == library.encode(text, add_eos=True)
        held = sum(len(k) + len(v) for k, v in own._ids.items())
        assert held == own._held <= 60 and len(own._ids) < 8


def test_encoded_documents(spark, codecs):
    own, _, path = codecs
    docs = table(spark, *ODD)
    rows = piece_codec.encode_documents(docs, path).collect()
    assert len(rows) == len(ODD) and rows[0].asDict().keys() >= set(docs.columns)
    for row in rows:
        assert [int(i) for i in row.ids.split(" ")] == own.encode(row.text) and row.decoded == (row.text or "")


# -- SimHash ----------------------------------------------------------------------------------


def test_simhash_edges(spark):
    docs = table(spark, *ODD, (7, "Plain WORDS here"), (8, None))
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {(r.id, r.fp): r.component_id for r in rows}
    assert {c for (i, f), c in got.items() if f == 0} == {2}
    assert {c for (i, f), c in got.items() if i in (1, 7)} == {1}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 6] and ids.count(None) == 1


def test_links_in_large_cells_equal_those_of_all_pairs(spark, monkeypatch):
    """Cells cut into many tiles keep every connection."""
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = random.Random(11)
    center = rng.getrandbits(64)
    near = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))) for _ in range(500)}
    values = sorted(near | {rng.getrandbits(64) for _ in range(200)})
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(prints, "fp")).collect()}
    array = np.array(values, dtype=np.uint64)
    expected = simhash.group_within(array, 2)
    for value, root in zip(signed, expected.tolist()):
        mine = roots.get(value, value)
        assert mine == root
    everything = np.bitwise_count(array[:, None] ^ array[None, :]) <= 2
    assert all(expected[a] == expected[b] for a, b in zip(*np.nonzero(everything)))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{n: 0 for n in range(1, 61)}, 101: 100}


@given(st.lists(st.integers(0, 4), max_size=40), st.integers(1, 7))
def test_groups_are_never_cut(values, size):
    rows = pd.DataFrame({"g": sorted(values), "n": range(len(values))})
    frames = [rows[at : at + size] for at in range(0, len(rows), size)]
    found = list(whole_groups(iter([rows[:0], *frames]), "g"))
    assert [n for f in found for n in f["n"]] == list(range(len(rows)))
    seen = [set(f["g"]) for f in found]
    assert all(not a & b for n, a in enumerate(seen) for b in seen[n + 1 :])


# -- substrings -------------------------------------------------------------------------------


def plain_dedup(rows, length):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        words = (text or "").split()
        gone = set()
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            if window in seen:
                gone.update(range(at, at + length))
            seen.add(window)
        out[doc] = (len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone))
    return out


@pytest.mark.parametrize("hot", [1, 3, 10_000])
def test_substrings_against_all_windows(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rng = random.Random(hot)
    shared = [[f"s{rng.randrange(30)}" for _ in range(rng.randrange(5, 40))] for _ in range(6)]
    rows = []
    for doc in range(80):
        words = []
        for _ in range(rng.randrange(5)):
            words += rng.choice(shared) if rng.random() < 0.7 else [f"w{rng.randrange(9)}" for _ in range(rng.randrange(30))]
        rows.append((doc, " ".join(words) if doc % 13 else None))
    rows += [(200, "a " * 50), (201, "a b " * 30), (202, "a " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup(docs, length=8, seed_words=3).collect()}
    assert got == plain_dedup(rows, 8)


@pytest.mark.parametrize("kind", ["string", "int", "date", "timestamp_ntz"])
def test_substrings_with_ids_of_any_order(spark, kind):
    rng = random.Random(11)
    rows = [(n, " ".join(rng.choice("abc") for _ in range(60))) for n in range(30)]
    made = {"date": "date_add(date'2024-01-01', n)", "timestamp_ntz": "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, n)"}
    docs = spark.createDataFrame(rows, "n int, text string").selectExpr(f"{made.get(kind, f'cast(n as {kind})')} AS doc_id", "text", "n")
    order = [r.n for r in docs.orderBy("doc_id").collect()]
    docs = docs.selectExpr(f"if(n = {order[-1]}, null, doc_id) AS doc_id", "text", "n")
    got = {r.id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.dedup(docs, length=8, seed_words=3).collect()}
    ids = {r.n: r.doc_id for r in docs.collect()}
    expected = plain_dedup([(place, dict(rows)[n]) for place, n in enumerate(order)], 8)
    assert got == {ids[n]: expected[place] for place, n in enumerate(order)}
    with pytest.raises(TypeError):
        substring_dedup.dedup(docs.selectExpr("cast(n as double) AS doc_id", "text"))


def test_substring_edges(spark):
    rows = substring_dedup.dedup(table(spark, *ODD)).collect()
    assert len(rows) == len(ODD)
    assert {(r.n_words, r.n_removed) for r in rows if r.id == 5} == {(20_000, 20_000 - 977 - 0)}
    assert next(r for r in rows if r.id == 2).n_words == 0


def test_null_and_repeated_ids_spread(spark, monkeypatch):
    rng = random.Random(3)
    passage = " ".join(f"s{n}" for n in range(12))
    texts = [f"{passage} " + " ".join(f"w{rng.randrange(500)}" for _ in range(20)) for _ in range(90)]
    rows = [(None if n % 3 == 0 else 7 if n % 3 == 1 else 100 + n, t) for n, t in enumerate(texts)] + [(7, texts[1])] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    seen = []
    plain = substring_dedup.removed_ranges
    monkeypatch.setattr(substring_dedup, "removed_ranges", lambda rows, dealt, *a: seen.append(dealt) or plain(rows, dealt, *a))
    got = substring_dedup.dedup(docs, length=8, seed_words=3).collect()
    assert sorted((r.id is None, r.id) for r in got if r.id is not None) == sorted((False, i) for i, _ in rows if i is not None)
    assert len(got) == len(rows) and len({(r.n_words, r.n_removed, r.kept) for r in got}) == 90
    assert len({r.kept for r in got if r.n_removed == 0}) == 1
    # Equal rows come once, and rows of one id are dealt apart.
    assert seen[0].count() == 90 and seen[0].select("row").distinct().count() == 90


def test_labelled_samples_are_bounded_in_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"good words number {n} " * 30) for n in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality_rules, "learn_rules", lambda frame, *a: seen.append(len(frame)) or [])
    quality_rules.decision_list(docs, labels, bound=40)
    assert seen == [40]
    assert toxicity.bounded(docs.select("doc_id"), 40).count() == 40


# -- quality ----------------------------------------------------------------------------------


def test_quality_edges(spark):
    docs = table(spark, *ODD)
    for labels in ([], [(1, None)], [(1, 0), (5, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        rows = quality_rules.judge(docs, frame).collect()
        assert len(rows) == len(ODD) and sum(r.kept for r in rows) == 0  # too short or all repeats
    stats = quality_rules.text_statistics("a b\n \na b\n#x a b")
    assert stats == (7, 8, 1, 1, 0, 3)
    assert quality_rules.text_statistics("a b c a b c") == (6, 6, 0, 0, 6, 1)


def test_rules_are_ordered_conditions(spark):
    frame = spark.createDataFrame(
        [(n, ("x# " if n % 3 == 0 else "good ") * (60 + n % 7) + f"end{n}", int(n % 3 != 0)) for n in range(120)],
        "doc_id long, text string, quality int",
    )
    rules = quality_rules.decision_list(frame.select("doc_id", "text"), frame.select("doc_id", "quality"))
    assert rules and all(len(tests) <= quality_rules.MOST_TESTS for tests in rules)
    text = str(quality_rules.verdict(rules))
    assert text.count("THEN false") == len(rules)
    rows = quality_rules.with_statistics(frame, keep=["quality"]).withColumn("kept", quality_rules.verdict(rules))
    assert rows.filter(F.col("kept") != (F.col("quality") == 1)).count() == 0


# -- clauses ----------------------------------------------------------------------------------


def plain_clauses(text, words, stems):
    """Clause scores by looking back from each match, without any machine."""
    tokens, found, now, last = text.lower().split(), [], 0.0, {}
    for n, token in enumerate(tokens):
        word = token.strip(toxicity._MARKS)
        weight = max([words.get(word, 0.0)] + [stems.get(word[:k], 0.0) for k in toxicity.STEMS if len(word) >= k])
        if not weight and word in toxicity.THREATS:
            weight = 1.0
        if weight:
            for names, reach, factor in (("target", 4, 1.5), ("negation", 3, 0.4), ("report", 6, 0.6)):
                if n - last.get(names, -99) <= reach:
                    weight *= factor
            now += weight
        else:
            for names, group in (("target", toxicity.TARGETS), ("negation", toxicity.NEGATIONS), ("report", toxicity.REPORTS)):
                if word in group:
                    last[names] = n
                    break
        if token[-1] in toxicity._ENDS:
            found += [now] if now else []
            now, last = 0.0, {}
    return len(tokens), found + ([now] if now else [])


def test_clause_scores_against_looking_back():
    rng = random.Random(12)
    lexicon = {"=idiot": 2.0, "^moro": 1.5, "^idio": 0.5, "=scum": 3.0}
    words, stems = {"idiot": 2.0, "scum": 3.0}, {"moro": 1.5, "idio": 0.5}
    vocabulary = ["idiot", "idiotic", "moron", "Scum", "kill", "you", "not", "said", "the", "a", "tree", "never", "claimed", "your", "töten", "é"]
    scorer = toxicity.Scorer(lexicon)
    for _ in range(500):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "!", "?", ";"]) for _ in range(rng.randrange(40)))
        size, found = scorer.clauses(text)
        expected = plain_clauses(text, words, stems)
        assert size == expected[0] and found == pytest.approx(expected[1]), text


def test_scores_are_those_of_the_plain_features(spark, folder):
    """The whole table, from texts to scores, without machine, batches or broadcast."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    words = {w[1:]: v for w, v in model.lexicon.items() if w[0] == "="}
    stems = {w[1:]: v for w, v in model.lexicon.items() if w[0] == "^"}
    for row in toxicity.score(docs, model).select("text", "score").collect():
        size, found = plain_clauses(row.text or "", words, stems)
        total = sum(found)
        features = [np.log1p(total), np.log1p(len(found)), max(found, default=0.0), np.log1p(100 * total / size) if size else 0.0, np.log1p(size)]
        z = sum(w * (f - m) / d for w, f, m, d in zip(model.weights, features, model.middle, model.spread)) + (model.weights[-1] if model.weights else 0)
        assert row.score == pytest.approx(1 / (1 + np.exp(-z)) if model.weights else 0.0, abs=1e-9)


# -- pages ------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a&nbsp;&lt;b&gt; &amp;\n c</p>", "a <b> & c"),
        ("<body><nav>menu</nav><article><h1>T</h1><p>One <b>two</b></p><div class='ad'>buy</div><br>x</article><footer>f</footer>", "T One two x"),
        ("<main><p>Long enough text for a page</p><section id=comments><p>hi</p></section><form>f</form></main><aside>s</aside>", "Long enough text for a page"),
        ("<div class=sidebar>s</div><div><h2>Head</h2><p>Body text that goes on and on for a while.</p></div>", "Head Body text that goes on and on for a while."),
        ("<article><p>cut off", "cut off"),
    ],
)
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>t</title><body><p>seen</p>", "seen"),
        ("<html><head><meta charset=utf-8><title>t</title><p>seen</p>", "seen"),
        ("<head><title>t</title>bare text", "bare text"),
        ("<head><title>t</title><b>seen</b> too", "seen too"),
        ("<ul><li class=ad>x<li>y<li>z</ul>", "y z"),
        ("<ul><li>a<ul><li class=ad>x</ul><li>b</ul>", "a b"),
        ("<ul><li class=ad>x<ul><li>y</ul>z<li>b</ul>", "b"),
        ("<div><p class=notice>x<p>y</div>", "y"),
        ("<p class=notice>x<ul><li>y</ul>", "y"),
        ("<div class=ad><p>x<p>y</div><p>z", "z"),
        ("<dl><dt class=ad>x<dd>y<dt>z</dl>", "y z"),
        ("<dl><dt>a<dd class=ad>x<dt>z</dl>", "a z"),
        ("<datalist><option class=ad>x<option>y</datalist>", "y"),
        ("<datalist><optgroup class=ad><option>x<optgroup><option>y</datalist>", "y"),
        ("<table><tr class=ad><td>x<tr><td>y</table>", "y"),
        ("<table><tr><td class=ad>x<td>y<tr><th class=ad>x<td>z</table>", "y z"),
        ("<table><tr class=ad><td><table><tr><td>x</table>x<tr><td>y</table>", "y"),
        ("<table><thead class=ad><tr><td>x<tbody><tr><td>y</table>", "y"),
        ("<table><caption class=ad>x<tr><td>y</table>", "y"),
        ("<ruby>a<rp class=ad>(<rt>b</ruby>", "a b"),
    ],
)
def test_left_out_end_tags(page, text):
    assert html_text.main_text(page) == text


PART = "<p>" + "A sentence of the story that goes on for a while and says something. " * 3 + "</p>"
LINKS = "<ul>" + "<li><a href=/x>Elsewhere</a>" * 8 + "</ul>"
TOLD = re.sub("<.*?>", "", PART).strip()


@pytest.mark.parametrize(
    "page, text",
    [
        # articles in parts, a teaser, a comment
        (f"<article>{PART}</article>{LINKS}<article>{PART}<p>End.</p></article>", f"{TOLD} {TOLD} End."),
        (f"<article>{PART * 3}</article><article><h2><a href=/y>Other</a></h2><p>See it.</article>", f"{TOLD} {TOLD} {TOLD}"),
        (f"<article>{PART}</article><article><p>Short part.</article><article>{PART}</article>", f"{TOLD} Short part. {TOLD}"),
        (f"<article>{PART}</article><article class=comment>{PART}</article>", TOLD),
        (f"<main><div>{PART * 2}</div>{LINKS}</main>", f"{TOLD} {TOLD} " + " ".join(["Elsewhere"] * 8)),
        # the ratio chooses against the element
        (f"<article><h2><a href=/y>Teaser</a></h2></article><div>{PART * 4}</div>", " ".join([TOLD] * 4)),
        # pages without article: links go, low lines within the text stay
        (f"<div>{LINKS}</div><div>{PART * 3}</div><div>{LINKS}</div>", f"{TOLD} {TOLD} {TOLD}"),
        (f"{LINKS}<h1>Head</h1>{PART * 3}{LINKS}", f"Head {TOLD} {TOLD} {TOLD}"),
        (
            f"<div><div>{PART * 4}</div><div>" + "<p>One.<p>Two.<p>Three.<p>Four.<p>Five." + f"</div><div>{PART * 4}</div></div>{LINKS}",
            " ".join([TOLD] * 4 + ["One. Two. Three. Four. Five."] + [TOLD] * 4),
        ),
        (
            f"<div>{PART * 4}<ul><li>Salt<li>Eggs<li>Flour<li>Milk<li>Oil<li>Rice</ul></div>{LINKS}",
            " ".join([TOLD] * 4 + ["Salt Eggs Flour Milk Oil Rice"]),
        ),
        ("<ul><li><a href=/a>only</a><li><a href=/b>links</a></ul>", "only links"),
    ],
)
def test_clusters_choose_regions(page, text):
    assert html_text.main_text(f"<html><body>{page}</body></html>") == text


WRAPPERS = [
    '<div class="content no-ads">{}</div>', '<div class="post no-comments">{}</div>', '<div class="entry comments-open">{}</div>',
    '<div class="shared-layout">{}</div>', '<div class="related-work">{}</div>', '<div class="promotions-law">{}</div>',
    '<div id="social-studies">{}</div>', '<main><div class="recommendations">{}</div></main>', "<form action=/page>{}</form>",
]
AROUND = [
    "{}", "<header>Site</header><nav><a href=/>Home</a></nav>{}<footer>Imprint</footer>",
    "<h1>Site</h1>{}<div class=comments>" + PART * 2 + "</div><div class=ad>Buy</div>",
    "{}<form><p>Search</p><input></form><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul>",
]


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_a_name_alone_takes_out_no_article(wrapper, around):
    body = wrapper.format(PART * 2 + "<div class=ad>Buy this now</div>")
    got = html_text.main_text(f"<html><body>{around.format(body)}</body></html>").removeprefix("Site ")
    if "comments>" not in around or any(w in wrapper for w in ("no-ads", "no-comments", "comments-open")):
        assert got == f"{TOLD} {TOLD}"
    else:
        # Two elements of such names and nothing beside them: both are taken for the text.
        assert got.startswith(f"{TOLD} {TOLD}")


@pytest.mark.parametrize("name", ["comments", "ad", "related", "share-bar", "newsletter", "cookie-notice"])
def test_doubtful_elements_go_where_text_is_left(name):
    assert html_text.main_text(f"<article>{PART}</article><div class={name}>{PART * 9}</div>") == TOLD
    assert html_text.main_text(f"<article><p>Short.</p><div id={name}>Or</div></article><div class={name}>{PART * 9}</div>") == "Short."
    assert html_text.main_text(f"<div>{PART}</div><div class={name}><form>{PART}</form>{PART}</div>") == TOLD


def test_unclosed_elements_in_great_number():
    started = time.time()
    assert html_text.main_text("<p><button>" + "<div>" * 60_000 + "</button>x") == "x"
    assert html_text.main_text("<ul>" + "<li><i>a" * 60_000).count("a") == 60_000
    assert time.time() - started < 30


CLASHES = ["__scan", "__email", "__TEXT", "N_Words", "__own", "Base_Spans", "__found", "__assign", "SCORE", "own_0_", "Kept"]


def test_columns_of_any_name_stay_as_they_are(spark):
    """Columns called like working columns, in any case, come through unchanged; those of a result's name give way."""
    values = [f"v{n}" for n in range(len(CLASHES))]
    rows = [(i, t, *values) for i, t in [(1, "mail a.b@c.de token=abcdefgh now"), (2, None)]]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{c}` string" for c in CLASHES]]))
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "none of these")], "item_id long, text string")
    pages = docs.withColumnRenamed("text", "html")
    for made, own in (
        (pii.find_personal(docs), {"base_spans", "spans", "spans_scores"}),
        (secret_scan.find_secrets(docs), {"base_spans", "spans"}),
        (quality_rules.judge(docs, labels), {*quality_rules.STATISTICS, "base_failed", "kept"}),
        (simhash.keep_one(docs), set()),
        (decontaminate.drop_contaminated(docs, bench), set()),
        (decontaminate.remove_spans(docs, bench), set()),
        (html_text.extract(pages), {"main_text"}),
        (toxicity.score(docs, toxicity.train(docs, labels)), {"score"}),
    ):
        found = made.collect()
        assert len(found) == 2
        for row in found:
            for name, value in zip(CLASHES, values):
                if name.lower() not in own:
                    assert row[name] == value, name


def test_the_least_of_equal_rows_stays(spark):
    rows = [(1, "a b c d", n, "s") for n in (5, 2, 9)] + [(2, "a b c d", 0, "s")]
    for some in (rows, rows[::-1]):
        docs = spark.createDataFrame(some, "doc_id long, text string, n int, source string").repartition(3, "n")
        assert [tuple(r) for r in simhash.keep_one(docs).collect()] == [(1, "a b c d", 2, "s")]
        mapped = docs.withColumn("m", F.create_map("source", "n"))
        assert simhash.keep_one(mapped).first().n == 2


def test_page_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x"), (None, None, None, "y"), (1, "u", "<p>a</p>", "x")], "page_id long, url string, html string, main_text string")
    rows = html_text.extract(pages).collect()
    assert sorted(r.main_text for r in rows) == ["", "a", "a"]
    deep = "<div>" * 3000 + "x" * 100_000
    assert html_text.main_text(deep) == "x" * 100_000


# -- toxicity ---------------------------------------------------------------------------------


def test_clauses_weigh_their_context():
    scorer = toxicity.Scorer({"=idiot": 2.0, "^scum": 1.0})

    def total(text):
        return round(sum(scorer.clauses(text)[1]), 6)

    assert total("such an idiot") == 2.0 and total("scummy") == 1.0 and total("nice day") == 0
    assert total("you are an idiot") > total("such an idiot") > total("not an idiot")
    assert total("he said idiot") < total("idiot")
    assert total("not here. idiot") == 2.0  # a clause ends what came before
    assert total("not one two three idiot") == 2.0  # too far away
    assert scorer.clauses("idiot. idiot scum")[1] == [2.0, 3.0]
    assert scorer.clauses(None) == (0, []) and scorer.clauses("") == (0, [])


def test_composition_multiplies_weights():
    negated = toxicity.compose(toxicity._match(toxicity.INSULT), toxicity._after(toxicity.NEGATION, 2, 0.5))
    state, weight = negated.step(0, toxicity.NEGATION)
    assert weight == 0 and negated.step(state, toxicity.INSULT)[1] == 0.5 and negated.step(0, toxicity.INSULT)[1] == 1


def test_toxicity_edges_and_held_out_labels(spark):
    texts = [(n, "kind words " * 20 + ("vile vile" if n % 4 == 0 else "fine")) for n in range(400)]
    docs = table(spark, *texts)
    labels = spark.createDataFrame([(n, int(n % 4 == 0)) for n, _ in texts], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    assert min(s for n, s in scores.items() if n % 4 == 0) > 0.7 > max(s for n, s in scores.items() if n % 4)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, turned) == model
    odd = toxicity.score(table(spark, *ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    nothing = toxicity.train(docs, labels.filter("false"))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


# -- empty tables -----------------------------------------------------------------------------


def test_empty_tables(spark, codecs):
    docs = table(spark).filter("false")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, html string")
    for frame in (
        quality_rules.judge(docs, labels), secret_scan.find_secrets(docs), decontaminate.contamination(docs, bench),
        license_scan.find_licenses(docs, license_scan.known_texts(spark)), pii.find_personal(docs),
        piece_codec.encode_documents(docs, codecs[2]), simhash.near_duplicates(docs), substring_dedup.dedup(docs),
        html_text.extract(pages), toxicity.score(docs, toxicity.train(docs, labels)),
    ):
        assert frame.count() == 0
