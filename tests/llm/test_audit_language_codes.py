"""Filter audit, language identification and vector codes against brute force and on odd tables."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import filter_audit, language_id, vector_codes
from tidemark.llm.queries import QUERIES

# -- filter audit -----------------------------------------------------------------------------


def plain_audit(names, cells):
    """Every order applied to the masks one filter after the other."""
    found = {}
    for order in itertools.permutations(names):
        left = dict(cells)
        for step, name in enumerate(order, 1):
            bit = 1 << names.index(name)
            gone = {m: w for m, w in left.items() if m & bit}
            left = {m: w for m, w in left.items() if not m & bit}
            fails = sum(w[0] for m, w in cells.items() if m & bit)
            n, good, toxic = (sum(w[k] for w in gone.values()) for k in range(3))
            alone = cells.get(bit, (0, 0, 0))[0]
            found["".join(order), step] = [sum(w[0] for w in left.values()), n, fails - n, alone, good, toxic]
    shapley = {x: sum(v[1] for (o, s), v in found.items() if o[s - 1] == x) for x in names}
    return {(o, s, *v, shapley[o[s - 1]]) for (o, s), v in found.items()}


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 5).flatmap(lambda n: st.tuples(st.just("ABCDE"[:n]), st.dictionaries(st.integers(0, 2**n - 1), st.tuples(*[st.integers(0, 9)] * 3)))))
def test_diagrams_give_what_filtering_gives(case):
    names, cells = case
    assert set(filter_audit.audit_part(names, cells)) == plain_audit(names, cells)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_plain_changes_reach_every_order_once(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for place in filter_audit.plain_changes(n):
        order[place], order[place + 1] = order[place + 1], order[place]
        seen.add(tuple(order))
    assert len(seen) == len(list(filter_audit.plain_changes(n))) + 1 == np.prod(range(1, n + 1))


def test_diagram_shares_equal_nodes():
    diagram = filter_audit.Diagram("ABC", {m: (1, 0, 0) for m in range(8)})
    assert [len(level) for level in diagram.levels] == [1, 1, 1]
    diagram.swap(0)
    assert [len(level) for level in diagram.levels] == [1, 1, 1] and diagram.order == list("BAC")


AUDITED = "doc_id long, text string, source string, mask string, n int, id string, good int, part int"


def audited(spark, rows, labels=()):
    docs = spark.createDataFrame([(i, t, s, "m", 1, "x", 2, 3) for i, t, s in rows], AUDITED)
    known = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return filter_audit.audit_documents(docs, known).toPandas()


def test_audit_of_odd_rows(spark):
    long = " ".join(f"w{n}" for n in range(30_000))
    fine = " ".join(f"w{n}" for n in range(300))
    rows = [
        (1, fine, "a"), (2, fine, "a"), (2, fine, "a"), (None, fine, "a"), (0, None, None), (3, "", None), (4, long, "b"),
        (5, "A# " * 300, "b"), (5, "A# " * 300, "b"), (None, "x", "b"),
    ]
    labels = [(2, 1, 0), (2, 0, None), (5, None, 1), (5, 0, 1), (0, 1, 1), (None, 1, 1), (9, 1, 1)]
    got = audited(spark, rows, labels)
    assert sorted(set(got.part)) == ["", "a", "b"] and len(got) == 3 * 600
    one = got.set_index(["part", "filter_order", "step"]).sort_index()
    # Copies of text 1 have larger ids; the row without an id isn't one.
    assert one.loc["a", "EABCD", 1][["kept", "removed", "good_lost", "toxic_lost"]].tolist() == [2, 2, 2, 0]
    assert one.loc["a", "EABCD", 1].shapley == 240 and one.loc["a", "ABCDE", 5].unique_fails == 2
    # A null text is an empty one, so the later of both is a copy.
    assert one.loc["", "EABCD", 1][["kept", "removed"]].tolist() == [1, 1]
    assert one.loc["", "AEBCD", 2][["removed", "redundant", "unique_fails"]].tolist() == [0, 1, 0]
    # Rows with one id are not smaller than one another.
    assert one.loc["b", "BACDE", 1][["kept", "removed", "toxic_lost"]].tolist() == [2, 2, 2]
    assert one.loc["b", "EABCD", 1].removed == 0


def test_audit_without_rows(spark):
    assert audited(spark, []).empty


# -- languages --------------------------------------------------------------------------------

SYLLABLES = {"aa": "ba be bi bo bu".split(), "bb": "ka ke ki ko ku".split(), "cc": "жа же жи жо жу".split()}


def sentence(rng, lang, words=40):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 5))) for _ in range(words))


def language_rows(n=150):
    rng = random.Random(7)
    return [(i, sentence(rng, lang), lang) for i, lang in zip(range(n), itertools.cycle(SYLLABLES))]


LANGUAGE = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def model(spark):
    return language_id.train(spark.createDataFrame(language_rows(), LANGUAGE))


def test_filters_hold_every_gram_that_a_language_has(model):
    rng = random.Random(8)
    names = model.languages
    assert set(names) == set(SYLLABLES)
    found, total, letters = model.counts([sentence(rng, lang) for lang in names])
    assert letters.all()
    for n in range(len(names)):
        assert found[n, n] > 0.9 * total[n]
        assert (np.delete(found[n], n) < 0.5 * total[n]).all()


def test_counts_of_stretches_are_those_of_a_plain_loop(model, monkeypatch):
    texts = ["Ba, be! жажо", None, "", "12 -", "x" * 70, "é́a ba", "ba\nbe", "ſß İka"]
    whole = model.counts(texts)
    monkeypatch.setattr(language_id, "AT_ONCE", 7)
    for a, b in zip(whole, model.counts(texts)):
        assert (a == b).all()
    expected = []
    for text in texts:
        low = f" {(text or '').lower()} "
        kinds = [language_id._kinds()[ord(c)] for c in low]
        grams = [
            (at, size)
            for size in language_id.SIZES
            for at in range(len(low) - size + 1)
            if all(kinds[at + 1 : at + size - 1]) and (kinds[at] or kinds[at + size - 1])
        ]
        expected.append(len(grams))
    assert whole[1].tolist() == expected


def test_language_of_odd_texts(spark, model):
    texts = ["babo kaku bibo bobu", None, "", "123 !", "漢字", "жажо жужи", " ".join(["kako"] * 100_000)]
    schema = "doc_id long, text string, lang_pred int, score string, __text int"
    rows = spark.createDataFrame([(i if i else None, t, 5, "s", i) for i, t in enumerate(texts)], schema)
    got = language_id.identify(rows, model).toPandas().set_index("__text").sort_index()
    assert got.lang_pred.tolist()[:4] == ["aa", "und", "und", "und"]
    assert got.lang_pred.tolist()[5:] == ["cc", "bb"]
    # A text that no language knows gets a learned value all the same.
    assert got.lang_pred[4] in SYLLABLES and got.score[4] == 0.0
    assert got.score.between(0, 1).all() and (got.score[[1, 2, 3]] == 0).all()


def test_languages_without_anything_to_learn(spark):
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(held[0], "ba be", "aa"), (None, "ba", None), (held[1], None, "bb")]
    for some in (rows, []):
        docs = spark.createDataFrame(some, LANGUAGE)
        model = language_id.train(docs)
        assert model.languages == ()
        assert {r.lang_pred for r in language_id.identify(docs, model).collect()} <= {"und"}


def test_many_languages_need_more_bits(spark):
    alphabet = [chr(0x4E00 + n) for n in range(280)]
    rows = [(n, " ".join(alphabet[4 * n : 4 * n + 4] * 3), f"l{n:02}") for n in range(70)]
    model = language_id.train(spark.createDataFrame(rows, LANGUAGE))
    assert len(model.languages) > 40
    texts = {lang: text for _, text, lang in rows}
    assert model.predict([texts[name] for name in model.languages])[0] == list(model.languages)
    wide = language_id.Model(tuple(f"x{n}" for n in range(70)), np.zeros((2, language_id.SLOTS), dtype=np.uint64), np.zeros(70))
    wide.masks[1, :] = 1 << 5
    assert wide.predict(["ab"])[0] == ["x69"]


def test_foreign_passages_leave_no_trace(spark):
    rng = random.Random(9)
    rows = [(i, t + (" " + sentence(rng, "bb", 10) if lang == "aa" and i % 20 == 0 else ""), lang) for i, t, lang in language_rows(900)]
    model = language_id.train(spark.createDataFrame(rows, LANGUAGE))
    assert model.predict([sentence(rng, "bb", 3) for _ in range(20)])[0] == ["bb"] * 20


def test_languages_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op12_language_id"](spark, folder).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")
    both = got.join(docs)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.index]).all()
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.995
    assert (held.lang_pred == held.lang).groupby(held.lang).mean().min() > 0.99


# -- vector codes -----------------------------------------------------------------------------


def plain_codes(ids, vectors, parts=16, entries=64, rounds=2):
    """Full comparison in whole numbers."""
    numbers = np.floor(np.asarray(vectors, dtype=np.float64) * 256).astype(np.int64)
    begun = [numbers[i] for i in sorted(range(len(ids)), key=lambda i: ids[i])[:entries]]
    cuts = vector_codes.cuts(numbers.shape[1], parts)
    books = [np.array([v[a:b] for v in begun]) for a, b in cuts]
    for last in range(rounds + 1):
        code, error = [], 0
        for n, (a, b) in enumerate(cuts):
            apart = ((numbers[:, None, a:b] - books[n][None]) ** 2).sum(axis=2)
            code.append(apart.argmin(axis=1))
            error = error + apart.min(axis=1)
            if last < rounds:
                for e in set(code[-1].tolist()):
                    mine = numbers[code[-1] == e][:, a:b]
                    books[n][e] = mine.sum(axis=0) // len(mine)
    text = ",".join(str(v) for book in books for v in book.ravel())
    return np.stack(code, axis=1), error, hashlib.sha256(text.encode()).hexdigest()


def coded(spark, rows, **sizes):
    schema = "vec_id long, embedding array<float>, label int, code string, low int, numbers string"
    vectors = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l, "c", 1, "n") for i, v, l in rows], schema)
    found, coder = vector_codes.code_vectors(vectors, **sizes)
    return vector_codes.with_label_error(found).toPandas().set_index("id").sort_index(), coder


@pytest.mark.parametrize("seed, spread, parts, entries", [(1, 0.2, 16, 64), (2, 0.004, 16, 64), (3, 30.0, 4, 16), (4, 0.02, 3, 40), (5, 0.2, 2, 1)])
def test_codes_are_those_of_a_full_comparison(spark, seed, spread, parts, entries):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 32))
    # A small spread makes many ties and equal parts, a large one far moves.
    vectors = (np.concatenate([centres[rng.integers(20, size=700)], np.zeros((50, 32))]) + rng.normal(size=(750, 32))) * spread
    ids = rng.permutation(750)
    got, coder = coded(spark, [(int(i), v, int(i) % 3 or None) for i, v in zip(ids, vectors.astype(np.float32))], parts=parts, entries=entries, rounds=3)
    code, error, digest = plain_codes(ids, vectors.astype(np.float32), parts, entries, 3)
    order = np.argsort(ids)
    assert got.code.tolist() == [c.astype(np.uint8).tobytes().hex() for c in code[order]]
    assert got.error.tolist() == error[order].tolist() and coder.digest() == digest
    by_label = got.groupby("label", dropna=False).error.transform("sum")
    assert (got.label_error == by_label).all() and got.label.isna().any()


@pytest.mark.parametrize("keep", [1, 2, 5, 9])
def test_bounds_never_claim_too_much(keep):
    rng = np.random.default_rng(keep)
    values, book = rng.integers(-60, 60, size=(500, 4)), rng.integers(-60, 60, size=(20, 4))
    near, low, outer, least = vector_codes.nearest(values, book, keep)
    for step in range(4):
        new = book + rng.integers(-9, 9, size=book.shape) * (rng.random((20, 1)) < 0.5)
        moves = vector_codes._above(((new - book) ** 2).sum(axis=1))
        book = new
        near, low, outer, least, used = vector_codes.renew(values, book, moves, near, low, outer, keep + step % 2)
        exact = vector_codes._exact(values, book)
        assert (near[:, 0] == exact.argmin(axis=1)).all() and (least == exact.min(axis=1)).all()
        true = np.sqrt(exact) * vector_codes.FINE
        kept = low != vector_codes.FAR
        assert (low <= np.take_along_axis(true, near, axis=1))[kept].all()
        others = true.copy()
        np.put_along_axis(others, near, np.inf, axis=1)
        assert (outer <= others.min(axis=1)).all()
        assert (np.diff(low[:, 1:], axis=1) >= 0).all() and (used >= 1).all()


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(6)
    fine = [(i, rng.normal(size=16).astype(np.float32), 1) for i in range(70)]
    odd = [(100, None, 1), (101, [None] * 16, 1), (102, [float("nan")] * 16, 2), (103, [float("inf")] * 16, 2), (104, [1.0] * 15, 2), (105, [], None)]
    huge = [(200, [3e38] * 16, None), (None, [0.5] * 16, None), (3, fine[3][1], 1)]
    got, coder = coded(spark, fine + odd + huge)
    assert len(got) == len(fine) + len(huge)
    assert set(got.index.dropna()) == {*range(70), 200}
    assert got.loc[3].code.nunique() == 1 and got.label_error.notna().all()
    assert [b.shape for b in coder.books] == [(64, 1)] * 16
    none, coder = coded(spark, odd)
    # The smallest usable id has fifteen components, the empty vector another length.
    assert none.index.tolist() == [104] and none.error.tolist() == [0]
    assert coded(spark, odd[-1:])[0].code.tolist() == ["00" * 16]
    assert coded(spark, [])[0].empty


def test_labels_that_fill_the_table(spark):
    rows = spark.range(4000).selectExpr("id", "cast(if(id % 2 = 0, 7, id) as int) as label", "'' as code", "id as error")
    got = vector_codes.with_label_error(rows).toPandas().set_index("id").sort_index()
    assert len(got) == 4000 and (got.label_error[::2] == sum(range(0, 4000, 2)) + 7).all()
    assert (got.label_error[1::2] == got.error[1::2]).mean() > 0.99


def test_state_of_earlier_rounds_is_removed(spark):
    import glob
    import os

    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:").rstrip("/")
    before = set(glob.glob(f"{folder}/vector-codes-*"))
    coded(spark, [(i, [float(i), 1.0], 1) for i in range(5)], parts=2, entries=2, rounds=3)
    left = {os.path.basename(f)[:14] for f in set(glob.glob(f"{folder}/vector-codes-*")) - before}
    assert left == {"vector-codes-2"}
