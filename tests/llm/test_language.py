import itertools
import zlib

import numpy as np
import pytest

from tests.llm.cases import documents, empty, odd_rows, prose
from tidemark.llm import language
from tidemark.llm.common import spread

WORDS = {
    "en": "the of and in to it on be are was for that this by as",
    "de": "der die das und in zu den von mit auf ist im sich des ein",
    "fr": "le la les de des et un une du en que est pour dans sur",
}


def texts(n, seed):
    return [(prose(seed * 1000 + i, 5 + i % 60, WORDS[k]), k) for i, k in zip(range(n), itertools.cycle(WORDS), strict=False)]


@pytest.fixture(scope="module")
def model():
    rows = texts(150, 1)
    return language.train([t.encode() for t, _ in rows], [k for _, k in rows])


def test_held_out_accuracy(model):
    rows = texts(200, 2)
    got = language.predict(model, [t.encode() for t, _ in rows])
    assert np.mean([g == k for (g, _), (_, k) in zip(got, rows, strict=True)]) > 0.98
    assert all(0 <= s <= 1 for _, s in got)


def test_switching_text_is_labelled_word_by_word(model):
    words = (prose(7, 30, WORDS["en"]) + " " + prose(8, 30, WORDS["de"])).split()
    p, _ = language.marginals(model.emissions(words), np.array([60]), model.transitions)
    found = [model.languages[i] for i in p.argmax(axis=1)]
    assert np.mean([f == ("en" if i < 30 else "de") for i, f in enumerate(found)]) > 0.9


def test_marginals_against_all_paths():
    rng = np.random.default_rng(1)
    lengths, size = np.array([5, 3, 3, 1]), 3
    e, t = rng.normal(size=(lengths.sum(), size)), rng.normal(size=(size, size))
    p, expected = language.marginals(e, lengths, t)
    want, steps, at = [], np.zeros((size, size)), 0
    for n in lengths:
        one, pairs, total = np.zeros((n, size)), np.zeros((size, size)), 0.0
        for path in itertools.product(range(size), repeat=int(n)):
            w = np.exp(sum(e[at + i, k] for i, k in enumerate(path)) + sum(t[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for i, k in enumerate(path):
                one[i, k] += w
            for a, b in itertools.pairwise(path):
                pairs[a, b] += w
        want.append(one / total)
        steps += pairs / total
        at += n
    assert np.allclose(p, np.concatenate(want)) and np.allclose(expected, steps)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 50])
def test_pieces_of_a_long_text_give_the_same_marginals(n):
    rng = np.random.default_rng(n)
    e, t = 3 * rng.normal(size=(n, 3)), rng.normal(size=(3, 3))
    want, _ = language.marginals(e, np.array([n]), t)
    got = dict(language._long(lambda x, y: e[x:y], n, t, 7))
    assert sorted(got) == list(range(0, n, 7))
    assert np.allclose(np.concatenate([got[x] for x in sorted(got)]), want)


def test_long_texts_are_read_like_short_ones(model):
    several = [t.encode() for t, _ in texts(12, 5)] + [b"", b"1 2 3", prose(1, 400, WORDS["de"]).encode()]
    whole, cut = (language.shares(model, several, at_once=n) for n in (1 << 18, 16))
    for a, b in zip(whole, cut, strict=True):
        assert (a is None) == (b is None) and (a is None or (np.allclose(a, b) and np.isclose(a.sum(), 1)))
    assert language.switches(model, several) == language.switches(model, several, at_once=16)
    assert [k for k, _ in language.predict(model, several, 16)] == [k for k, _ in language.predict(model, several)]


def test_runs_of_a_switching_text(spark, model):
    text = "12 " + prose(7, 40, WORDS["en"]) + " -- " + prose(8, 60, WORDS["de"])
    rows = [(1, text, None, "s", 0), (2, None, None, "s", 0), (3, "", None, "s", 0), (4, "7 8 9", None, "s", 0), (4, text, None, "s", 0)]
    found = language.runs(documents(spark, rows), model).collect()
    mine = [(r["first_word"], r["end_word"], r["lang"]) for r in found if r["doc_id"] == 1]
    assert mine[0][0] == 0 and mine[-1][1] == 102 and all(a[1] == b[0] and a[2] != b[2] for a, b in itertools.pairwise(mine))
    right = sum(max(0, min(y, 42) - x) if k == "en" else max(0, y - max(x, 42)) if k == "de" else 0 for x, y, k in mine)
    assert right > 0.9 * 102
    assert [(r["first_word"], r["end_word"], r["lang"]) for r in found if r["doc_id"] == 4][:1] == [(0, 3, "und")]
    assert sorted(r["doc_id"] for r in found) == sorted([1] * len(mine) + [4] * (len(mine) + 1))
    assert language.runs(empty(spark), model).collect() == []


def test_shares_name_every_language(spark, model):
    got = language.label(documents(spark), model, ("lang_pred", "score", "shares")).collect()
    for r in got:
        assert (r["shares"] == {}) == (r["lang_pred"] == "und")
        if r["shares"]:
            assert sorted(r["shares"]) == model.languages and np.isclose(sum(r["shares"].values()), 1)
            assert max(r["shares"], key=r["shares"].get) == r["lang_pred"]


def test_odd_rows(spark, model):
    labelled = language.label(documents(spark), model)
    assert labelled.columns.count("score") == 1
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in labelled.collect()}
    for i in (1, 2, 3, 9):
        assert got[i] == ("und", 0.0)
    assert got[4][0] == "en" and got[10][0] in WORDS
    kept = language.accepted(documents(spark), model)
    assert kept.columns == documents(spark).columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd_rows())
    assert language.label(empty(spark), model).collect() == []


def test_fit_uses_no_held_out_row(spark):
    rows = [(i, t, k, "s", 0) for i, (t, k) in enumerate(texts(60, 3))]
    other = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else k, s, n) for i, t, k, s, n in rows]
    a, b = (language.fit(documents(spark, x)) for x in (rows, other))
    assert a.languages == b.languages == sorted(WORDS) and np.array_equal(a.weights, b.weights)


def test_nothing_to_learn_from(spark):
    model = language.fit(empty(spark))
    assert {(r["lang_pred"], r["score"]) for r in language.label(documents(spark), model).collect()} == {("und", 0.0)}


def test_a_language_of_long_texts_is_learned(spark):
    words = {"aa": "lorka mitu sanav", "bb": "wexor quid zymph"}
    rows = [(i, prose(i, 12_000 if lang == "bb" else 60, words[lang]), lang, "s", 0) for i in range(40) for lang in [("aa", "bb")[i % 2]]]
    assert all(len(r[1]) > language.TRAIN_CHARS for r in rows if r[2] == "bb")
    model = language.fit(documents(spark, rows))
    assert model.languages == ["aa", "bb"]
    assert [x for x, _ in language.predict(model, [prose(900, 30, w).encode() for w in words.values()])] == ["aa", "bb"]


def test_pieces_are_spread_and_bounded():
    text = " ".join(f"w{i:05}" for i in range(20_000))
    cut = spread(text, 4_000)
    assert len(cut) <= 4_000 and set(cut.split()) <= set(text.split()) and "w00000" in cut and "w19999" in cut
    assert spread("short", 4_000) == "short" and len(spread("x" * 9_000, 4_000)) <= 4_000


def test_a_repeated_id_teaches_by_one_text_of_a_length(spark, monkeypatch):
    rows = [(1, f"lorka mitu {i:05}", "aa", "s", 0) for i in range(500)] + [(i, prose(i, 20, "wexor quid"), "bb", "s", 0) for i in range(2, 12)]
    sizes, whole = [], language.train
    monkeypatch.setattr(language, "train", lambda texts, langs: sizes.append(langs) or whole(texts, langs))
    language.fit(documents(spark, rows))
    assert sizes[0].count("aa") == 1 and sizes[0].count("bb") > 4
