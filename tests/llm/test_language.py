import math
import random
import re
import string
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import language
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    found = QUERIES["op4_nearest_centroid"](spark, SF)
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(langs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_rows(documents):
    texts = {"aa": "kala maka tala naka lasa", "bb": "zyxo wyzo xyro qyzo vyxo"}
    rows = [(i, f"{t} {i}", g, None) for i in range(200) for g, t in texts.items()]
    odd = [(900, None, "aa", None), (901, "", "aa", None), (902, "12 34!", "bb", None), (903, "KALA tala", None, None),
           (904, "kala " * 300_000, None, None), (None, "zyxo", None, None), (905, "日本語", None, None)]
    out = language.identify(documents(rows + odd))
    got = {r.doc_id: r for r in out.where("doc_id >= 900 or doc_id is null").collect()}
    assert out.count() == len(rows) + len(odd) and out.columns.count("score") == 1
    assert [got[i].lang_pred for i in (900, 901, 902, 903, 904)] == ["und", "und", "und", "aa", "aa"]
    assert got[None].lang_pred == "bb" and got[900].rejected and not got[903].rejected and got[905].rejected


def counted(rows):
    """Training rows as ``fitted`` takes them."""
    counts = [(lang, language.gram_counts(text)) for lang, text in rows]
    return [(lang, np.nonzero(c)[0], c[np.nonzero(c)[0]]) for lang, c in counts]


@pytest.mark.parametrize("unlearned", ["de", "es", "fr"])
def test_long_texts_of_an_unlearned_language_and_junk_are_rejected(unlearned):
    rows = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    rows = [(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2, r["lang"], r["text"]) for r in rows if language.has_letter(r["text"])]
    model = language.fitted(counted([(g, t) for held, g, t in rows if not held and g != unlearned]), 1)
    unknown = [t for _, g, t in rows if g == unlearned and len(t) > 500]
    known = [t for held, g, t in rows if held and g != unlearned]
    rng = random.Random(1)
    junk = ["".join(rng.choice(letters) for _ in range(n)) for letters in (string.ascii_lowercase + "  ", string.ascii_letters + "0+/")
            for n in (300, 1000, 5000)]
    assert all(model.predict(t)[2] for t in junk)
    assert sum(model.predict(t)[2] for t in unknown) >= 0.9 * len(unknown) > 20
    assert sum(model.predict(t)[2] for t in known) <= 0.01 * len(known)


def test_least_cosines_follow_each_length_class():
    # One odd short text lowers its own class alone; an odd long one is averaged away.
    classes = np.array([3] + [8] * 50 + [12] * 50 + [15])
    floor = language.low_cosines(classes, np.array([0.1] + [0.6] * 50 + [0.9] * 50 + [0.2]))
    assert floor[2] == 0 and floor[3] == floor[7] == 0.1 and floor[8] == 0.6 and floor[12] == floor[63] > 0.88
    assert (np.diff(floor) >= 0).all()


def test_sample_is_bounded_and_split_by_language(documents, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 40)
    rows = [(i, "kala maka", "aa", None) for i in range(900)] + [(i, "zyxo wyzo", "bb", None) for i in range(900, 905)]
    model = language.train(documents(rows), F.lit(True), "doc_id", "text", "lang")
    assert model.languages == ["aa", "bb"] and model.predict("zyxo")[0] == "bb"


def test_slices_count_like_the_whole(monkeypatch):
    text = "abc déf " * 50
    texts = [text, "", "a", "ab  1 c", "  ", "12 3", "ΑΣ ΑΣΑ " * 9, "x" * 40, "é, " * 17 + "z", "İstanbul " * 5, "日本語 한국어"]
    whole = [language.gram_counts(t) for t in texts]
    for size in (1, 2, 3, 7, 8, 64):
        monkeypatch.setattr(language, "SLICE", size)
        assert all((language.gram_counts(t) == w).all() for t, w in zip(texts, whole)), size


def plain_counts(text):
    """Grams of the whole text, one by one."""
    letters = " " + "".join(c if c.isalpha() else " " for c in text.replace("Σ", "σ").lower()) + " "
    codes = [ord(c) for c in re.sub(" +", " ", letters)]
    found, offset = {}, 0
    for order, size in enumerate(language.SIZES, 1):
        for start in range(len(codes) - order + 1):
            mixed = 0
            for code in codes[start : start + order]:
                mixed = (mixed + code) * 0x9E3779B97F4A7C15 % 2**64
            place = offset + (mixed >> 40) % size
            found[place] = found.get(place, 0) + 1
        offset += size
    return found


def test_predictions_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs, ~language.held_out("doc_id"), "doc_id", "text", "lang")
    got = language.predict_languages(docs, model).collect()
    assert len(got) == 200
    for r in got:
        if not language.has_letter(r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        counts = plain_counts(r.text)
        weights = {p: math.log1p(n) * float(model.idf[p]) for p, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * float(c[p]) for p, w in weights.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        own = model.owner[best]
        near = max(c for c, o, many in zip(cosines, model.owner, model.common) if many and o == own)
        floor = model.floor[own, sum(n for p, n in counts.items() if p < language.SIZES[0]).bit_length()]
        assert r.lang_pred == model.languages[own] and abs(r.score - cosines[best]) < 1e-5
        assert r.rejected == (near < floor) or abs(near - floor) < 1e-5


def test_sample_of_repeated_ids_and_many_languages(documents, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 600)
    seen = []
    monkeypatch.setattr(language, "fitted", lambda sample, seed: seen.append(sample))
    letters = "abcdefghijklmnopqrst"
    rows = [(i, f"{letters[g % 20] * 3} {letters[g // 20] * 4} x", f"l{g}", None) for i, g in enumerate(range(300)) for i in (i, i, 1000 + g, 5000 + g)]
    rows += [(7, f"abc {'z' * (i % 50)}", "l7", None) for i in range(300)] + [(8, None, "l8", None), (None, "abc", "l9", None)]
    language.train(documents(rows), F.lit(True), "doc_id", "text", "lang")
    language.train(documents(rows[::-1]), F.lit(True), "doc_id", "text", "lang")
    (one, two), kinds = seen, lambda sample: [(g, at.tolist(), n.tolist()) for g, at, n in sample]
    assert len(one) == 600 and {sum(g == f"l{k}" for g, *_ in one) for k in range(300)} == {2} and kinds(one) == kinds(two)


def test_few_texts_of_a_language_do_not_count():
    # Exact tail of the binomial distribution.
    exact = sum(math.comb(200, i) * 0.05**i * 0.95 ** (200 - i) for i in range(5))
    assert abs(language.at_most(4, 200, 0.05) - exact) < 1e-12 and language.at_most(200, 200, 0.05) > 0.999
    assert language.at_most(1, 40, 0.05) > language.RARE > language.at_most(20, 1000, 0.05)


def test_without_training_rows(documents):
    got = language.identify(documents([(1, "abc"), (2, None)])).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in got] == [("und", 0.0, True)] * 2
    assert language.identify(documents([])).collect() == []
