import random
from hashlib import sha256

import pytest
from tokenizers import Tokenizer

from millrace.llm import trie_bpe
from millrace.llm.queries import vocabulary
from millrace.llm.trie_bpe import TextCoder, encode_texts

PATH = vocabulary("word_bpe_49k.json")
ODD = [
    "", "  ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>", "ΑΣ ΟΔΥΣΣΕΥΣ", "İstanbul", "é café",
    "x\x1cy\x1dz", "a\x85b c　d", "don't I'LL you've 'S", "1234 ½²٣", "日本語 テスト", "😀😀 a😀b", "́abc",
    "ǅ ﬁ ẞ", "aaaaaaaaaaaaaa" * 50, "\x00\x01", "​﻿", "K Å Ω", "ŉ ĳ Ŀ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(library):
    rng = random.Random(5)
    alphabets = ["abcdefghij klm", "aaab", "éèüßñ aBC", "'sdtrevml ab", "0123abc!?., #$", "日本語abc😀́ \t\n", "İΣσ \x85\x1c"]
    texts = ODD + ["".join(rng.choice(a) for _ in range(rng.randint(1, 80))) for a in alphabets for _ in range(150)]
    coder = TextCoder(PATH)
    for text, (ids, decoded) in zip(texts, coder.coded(texts), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_memory_is_bounded(library, monkeypatch):
    """Words are forgotten and learnt again, in small groups, with the same ids."""
    monkeypatch.setattr(trie_bpe, "REMEMBERED", 20_000)
    monkeypatch.setattr(trie_bpe, "STEPS", 100)
    monkeypatch.setattr(trie_bpe, "LEARNT", 500)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abdenrst") for _ in range(rng.randint(1, 9))) for _ in range(40)) for _ in range(120)]
    texts[50] = "ab" * 5000
    coder = TextCoder(PATH)
    for text, (ids, _) in zip(texts, coder.coded(texts)):
        assert ids == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))
        assert len(coder.known) < 1000


def test_rows(library, documents):
    long = "über lang " * 60_000
    rows = [(1, "One two"), (2, None), (3, ""), (4, long), (1, "One two"), (None, "x")]
    got = encode_texts(documents(rows), PATH).collect()
    assert sorted(r.n_tokens for r in got)[:3] == [0, 0, 1] and len(got) == 6
    for row in got:
        text = next(t for i, t in rows if i == row.doc_id) or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert row.ids == ids
        assert row.ids_sha256 == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(documents):
    assert encode_texts(documents([]), PATH).collect() == []
