import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from millrace.llm import spelling
from millrace.llm.spelling import BidirectionalIndex, Ranks, near_words, slipped, spelling_groups

LETTER = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | {chr(i) for i in range(0xC0, 0x100)}


def edits(a, b):
    """Plain edit distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def plain_runs(text):
    run, runs = "", []
    for c in (text or "") + " ":
        if c in LETTER:
            run += c.lower() if c.isascii() else c
        elif run:
            runs.append(run)
            run = ""
    return runs


def brute(rows, shortest=6, rarest=5, times=5):
    counts = Counter()
    for doc, text in rows:
        for run in plain_runs(text):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= rarest}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and edits(v, w) == 1] for w in words}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[word] = best if best and words[best] >= times * words[word] else None
    out = []
    for word, form in forms.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, form, root, words[word], len(near[word]), words[form] if form else None))
    return sorted(out, key=str)


def check(df):
    found = spelling_groups(df)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute(rows)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    return want


def vocabulary(letters, count, sizes, seed=1):
    pick = random.Random(seed)
    return sorted({"".join(pick.choice(letters) for _ in range(pick.randint(*sizes))) for _ in range(count)})


@pytest.mark.parametrize("letters", ["a", "ab", "abé÷", "abcdefghijklmnopqrstuvwxyzàéîõü"])
def test_index_finds_all_near_words(letters):
    words = vocabulary(letters, 300, (6, 9))
    tree = BidirectionalIndex(words)
    for half_of in (lambda n: n // 2, lambda n: (n - 1) // 2):
        for right in (True, False):
            halves = [half_of(len(w)) for w in words]
            found = {(words[a], words[b]) for a, b in zip(*tree.near(words, halves, right))}
            kept = (lambda a, b, h: a[:h] == b[:h]) if right else (lambda a, b, h: a[-h:] == b[-h:])
            assert {(a, b) for a, b in found if edits(a, b) != 1} == set()
            # The error may lie anywhere but in the half, and the half may end with it.
            want = {(a, b) for a, h in zip(words, halves) for b in words if edits(a, b) == 1 and kept(a, b, h)}
            assert found <= want | found and {(a, b) for a, b in want if len(a) <= len(b)} <= found


def test_lookups_of_words_that_are_not_indexed():
    tree = BidirectionalIndex(["garden", "wooden"])
    asked, found = tree.near(["gardens", "garde", "xarden", "gxrden", "qqqqqq"], [3, 2, 3, 3, 3], False)
    assert sorted(zip(asked.tolist(), found.tolist())) == [(2, 0), (3, 0)]
    asked, found = tree.near(["gardens", "garde", "xarden", "garzen"], [3, 2, 3, 3], True)
    assert sorted(zip(asked.tolist(), found.tolist())) == [(0, 0), (1, 0), (3, 0)]


def test_intervals_stay_in_step():
    """Extending left and right in any order gives the places where the text occurs."""
    words = vocabulary("abc", 80, (6, 8))
    tree, text = BidirectionalIndex(words), "$" + "".join(w + "$" for w in words)
    codes = {c: np.array([i]) for c, i in tree.code.items()} | {"$": np.array([spelling.DELIMITER])}
    pick = random.Random(4)
    for _ in range(60):
        start = pick.randrange(3, len(text) - 3)
        left, right, match = start, start, tree.everything(1)
        for _ in range(5):
            if pick.random() < 0.5 and left:
                left -= 1
                match = tree.extend(match, codes[text[left]], False)
            elif right < len(text):
                match = tree.extend(match, codes[text[right]], True)
                right += 1
        low, back, size = (int(x[0]) for x in match)
        part = text[left:right]
        places = {i for i in range(len(text)) if text.startswith(part, i)} if part else set(range(len(text) + 1))
        assert set(tree.forward.suffixes[low : low + size].tolist()) == places
        ends = {len(text) - int(i) for i in tree.backward.suffixes[back : back + size]}
        assert ends == {i + len(part) for i in places} or not part


def test_counts_between_kept_places():
    symbols = np.append(np.random.default_rng(2).integers(1, 7, 100), 0)
    ranks = Ranks(symbols, 7)
    last = symbols[ranks.suffixes - 1]
    for place in range(102):
        want = np.bincount(last[:place], minlength=7)
        assert ranks.counts(np.array([place]))[0].tolist() == want.tolist()
        assert [int(ranks.below(np.array([place]), np.array([c]))[0]) for c in range(8)] == [0, *np.cumsum(want)]


def test_slips():
    lost = [(d, w) for d in range(300) for w in ("garden", "wooden") if slipped(str(d), w) != w]
    assert lost and all(len(slipped(str(d), w)) == 5 for d, w in lost)


@pytest.mark.parametrize("blocks", [False, True])
def test_pairs_over_indexes(spark, blocks, monkeypatch):
    """Many indexes; and halves that so many words share that they fill several blocks."""
    monkeypatch.setattr(spelling, "PER_INDEX", 400)
    monkeypatch.setattr(spelling, "MOST", 300)
    words = vocabulary("ab", 60, (6, 7)) + (["same" + w for w in vocabulary("abcd", 90, (4, 4))] if blocks else vocabulary("abcde", 60, (6, 10)))
    words = sorted(set(words))
    df = spark.createDataFrame(pd.DataFrame({"word": words, "n": range(1, len(words) + 1)}))
    found = sorted((r.word, r.near, r.n) for r in near_words(df).collect())
    assert found == sorted((a, b, i) for a in words for i, b in enumerate(words, 1) if edits(a, b) == 1)


def test_given_documents(spark):
    assert check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))


def test_odd_rows(spark, documents):
    rows = [(None, "Gärten " * 30), (1, None), (2, ""), (3, "garden, GARDEN;garden1garden_" * 40), (4, "gardem " * 15), (4, "gardem " * 15)]
    rows += [(5, "gardens " * 5 + "garzem " * 5 + "short " * 9 + "Gärtem " * 5), (6, "éàüÉÀÜ×÷ " * 5), (None, "wooden-" * 5)]
    rows += [(7, "x" * 3_000 + " " + ("x" * 3_001 + " ") * 6), (8, ("x" * 3_000 + " ") * 40), (9, "gArDen " * 100_000)]
    df = documents(rows).withColumnRenamed("size", "word").withColumnRenamed("ids", "n")
    assert {r[:3] for r in check(df)} >= {("garzem", "gardem", "garden"), ("gardem", "garden", "garden")}


def test_ties_go_to_the_first_word(spark, documents):
    words = check(documents([(1, "aaaaab " * 50 + "aaaaac " * 50 + "aaaaad " * 5)]))
    assert ("aaaaad", "aaaaab", "aaaaab", 5, 2, 50) in words


def test_empty_table(spark, documents):
    assert spelling_groups(documents([])).collect() == []
    assert spelling_groups(documents([(1, "one two 12")])).collect() == []
