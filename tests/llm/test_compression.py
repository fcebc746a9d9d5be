import base64
import random
import re
from collections import Counter

import zstandard

from millrace.llm.compression import Bands, judge_texts, measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 8))
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_measures_equal_brute_force():
    rng = random.Random(0)
    for _ in range(3000):
        text = "".join(rng.choice("ab \n\t#é\x0b\x85\xa0\x1c") for _ in range(rng.randrange(150)))
        assert measures(text) == brute(text), text


def prose(rng, n):
    vowels, others = "aeiou", "bcdfghlmnprst"
    words = ["".join(rng.choice(others) + rng.choice(vowels) for _ in range(rng.randrange(1, 5))) for _ in range(n)]
    return " ".join(words)


def test_verdicts(documents):
    rng = random.Random(3)
    noise = base64.b64encode(rng.randbytes(9000)).decode()
    noise = " ".join(noise[i : i + 60] for i in range(0, len(noise), 60))
    lines = "\n".join(f"row {i} of the same long table of nothing at all, again and on" for i in range(400))
    rows = [(1, prose(rng, 30)), (2, prose(rng, 300)), (3, prose(rng, 5000)), (4, noise), (5, lines),
            (6, prose(rng, 2000) + " " + noise * 3), (7, "a b c"), (8, None), (9, ""), (None, prose(rng, 50)), (1, prose(rng, 40)),
            (10, prose(rng, 200_000))]
    got = {r.doc_id: r for r in judge_texts(documents(rows)).collect()}
    assert [got[i].kept for i in (2, 3, 10, None)] == [True] * 4
    assert [got[i].kept for i in (4, 5, 6, 7, 8, 9)] == [False] * 6
    assert [got[i].base_failed for i in (4, 6, 7, 8, 9)] == [False, False, True, True, True]
    assert got[8].ratio is None and got[9].n_words == 0
    for i, text in rows[1:6]:
        data = text.encode()
        assert got[i].ratio == len(data) / len(zstandard.ZstdCompressor(level=3).compress(data))
        assert got[i].chunks == len(data) // 4096
    assert judge_texts(documents(rows)).count() == len(rows)


def test_tails_short_texts_and_many_strays_are_judged(documents):
    rng = random.Random(5)
    noise = lambda n: base64.b64encode(rng.randbytes(n)).decode()[:n]
    clean = lambda n: prose(rng, n)[:n]
    wide = " ".join(noise(12) for _ in range(2000))
    rows = [(1, clean(6000)), (2, clean(4096) + wide[:4000]), (3, wide[:4096] + clean(3 * 4096) + wide[:4095]), (4, clean(1500)),
            (5, clean(1400) + wide[:1400]), (6, clean(150)), (7, "buy now " * 19), (8, "x1 " * 45),
            (9, clean(90 * 4096) + wide[: 3 * 4096] + clean(90 * 4096)), (10, clean(90 * 4096) + wide[:4096] + clean(90 * 4096))]
    bands = Bands()
    press = zstandard.ZstdCompressor(level=bands.level).compress
    kept = {}
    for i, text in rows:
        data = text.encode()
        kept[i] = bands.keeps(len(data), len(data) / len(press(data)), *bands.outside(data, press))
    assert kept == {1: True, 2: False, 3: False, 4: True, 5: False, 6: True, 7: False, 8: False, 9: False, 10: True}
    got = {r.doc_id: r for r in judge_texts(documents(rows)).collect()}
    assert all(got[i].kept == (kept[i] and not got[i].base_failed) for i, _ in rows)
    assert got[1].kept and got[4].kept and not got[3].base_failed and got[3].chunks == 4


def test_limits_are_inclusive():
    bands = Bands()
    assert bands.keeps(500, 3.2, 0, 0) and not bands.keeps(500, 3.21, 0, 0)
    assert bands.keeps(9000, 2.0, 1, 4) and not bands.keeps(9000, 2.0, 2, 4) and bands.keeps(100, 0.5, 0, 0)


def test_empty_table(documents):
    assert judge_texts(documents([])).collect() == []
