import random
import re

import numpy as np
import pytest
from fractions import Fraction

from millrace.llm import jaccard_join
from millrace.llm.components import components
from millrace.llm.jaccard_join import Shingler, jaccard_components, signatures, sketch_distance, sketch_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, words=3, threshold="0.9"):
    """Component of every row by comparing all pairs."""
    limit = Fraction(threshold)
    sets = [shingle_set(t, words) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and None not in (rows[i][0], rows[j][0]):
                if both * limit.denominator >= limit.numerator * (len(sets[i]) + len(sets[j]) - both):
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    least = {}
    for (doc, _), g in zip(rows, group):
        if doc is not None:
            least[g] = min(doc, least.get(g, doc))
    return sorted(
        ((d, len(s), least[g] if d is not None else None) for (d, _), s, g in zip(rows, sets, group)), key=str
    )


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"add{rng.randrange(10**6)}")
        elif len(words) > 4:
            del words[at]
    return words


def corpus(seed):
    """Families of copies at all distances, templates with a common passage, short texts."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    passage, texts = fresh(80), []
    for _ in range(6):
        base = fresh(rng.choice([12, 40, 150, 400]))
        texts += [" ".join(edited(rng, base, rng.randrange(0, max(2, len(base) // 25)))) for _ in range(rng.choice([3, 25, 60]))]
    texts += [" ".join(passage + fresh(rng.choice([2, 5, 9, 60]))) for _ in range(60)]
    texts += ["a b", "A b", "a\tb", "a", "a", "", " \n", None, "x y z", "X Y Z", "x y z w"] + [texts[0]] * 30
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (7, texts[7]), (None, None)]


@pytest.mark.parametrize("seed,rare,counted", [(1, 16, 0.25), (2, 2, 0.25), (3, 0, 1.0), (4, 5, 1.0), (5, 10**6, 0.25)])
def test_components_equal_brute_force(documents, monkeypatch, seed, rare, counted):
    # Few or many frequent fingerprints: single tokens, combinations and both.
    monkeypatch.setattr(jaccard_join, "RARE", rare)
    monkeypatch.setattr(jaccard_join, "COUNTED", counted)
    rows = corpus(seed)
    got = sorted((tuple(r) for r in jaccard_components(documents(rows)).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("threshold", ["0.3", "0.5", "0.6", "0.7", "0.75", "0.8", "0.85", "0.9", "0.95", "1"])
def test_similar_sets_share_a_signature(threshold):
    """All sizes from 1 on; no, some or all fingerprints frequent, extra ones anywhere."""
    rng, limit, tried = random.Random(9), Fraction(threshold), 0
    for n in [*range(1, 61), 120, 200]:
        for share in (0.0, 0.5, 0.93, 1.0, 1.0):
            for _ in range(20):
                base = rng.sample(range(10**6), n)
                most = int((1 - limit) * n)
                drop = rng.randint(0, min(most, n - 1))
                add = rng.randint(0, most + 1)
                other = rng.sample(base, n - drop) + rng.sample(range(10**6), add)
                x, y = (np.unique(np.array(s, np.int64)) for s in (base, other))
                both, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
                if both < limit * union or both == union:
                    continue
                tried += 1
                frequent = np.array([t for t in np.union1d(x, y).tolist() if rng.random() < share], np.int64)
                (_, a), (_, b) = (signatures(s, frequent, limit) for s in (x, y))
                assert set(a.tolist()) & set(b.tolist()), (n, drop, add)
                assert sketch_distance(sketch_of(x), sketch_of(y)) <= union - both
    assert tried > 500 or threshold in ("0.95", "1")


def test_small_frequent_sets_keep_their_links(documents):
    """Groups of copies of eight and of nine words: sets of four and five, all frequent."""
    rows = []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(9)]
        rows += [(100 * g + i, " ".join(words[:8])) for i in range(20)] + [(100 * g + 20 + i, " ".join(words)) for i in range(20)]
    got = sorted((tuple(r) for r in jaccard_components(documents(rows), words=5, threshold="0.8").collect()), key=str)
    assert got == brute(rows, 5, "0.8") and len({c for _, _, c in got}) == 12


@pytest.mark.parametrize("words,threshold", [(5, "0.8"), (2, "0.6"), (1, "0.5")])
def test_other_measures_equal_brute_force(documents, monkeypatch, words, threshold):
    monkeypatch.setattr(jaccard_join, "RARE", 2)
    rows = [r for r in corpus(6) if not r[1] or len(r[1]) < 2000][:160]
    got = sorted((tuple(r) for r in jaccard_components(documents(rows), words=words, threshold=threshold).collect()), key=str)
    assert got == brute(rows, words, threshold)


def test_thresholds_out_of_range(documents):
    for wrong in ("0", "1.1", "-0.5"):
        with pytest.raises(ValueError):
            jaccard_components(documents([]), threshold=wrong)


def test_long_text(documents):
    words = [f"w{i % 7919}x{i % 13}" for i in range(120_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-500])), (3, " ".join(words[:60_000]))]
    got = {r.doc_id: r.component_id for r in jaccard_components(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_empty_table(documents):
    assert jaccard_components(documents([])).collect() == []


def test_shingler_normalises():
    shingle = Shingler(3)
    assert (shingle("A b C") == shingle(" a\nB c ")).all() and len(shingle("É b c")) == 1
    assert shingle("É b c")[0] != shingle("é b c")[0] and len(shingle(None)) == 0


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1400)]
    links += [(i, i + 1) for i in range(5000, 5040)] + [(7, 7), (5, 6), (6, 5)]
    group = {v: v for pair in links for v in pair}
    for _ in range(400):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    single = {v for v in group if not any(a != b and v in (a, b) for a, b in links)}
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {v: g for v, g in group.items() if v not in single}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
