import random

import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from millrace.llm.queries import vocabulary
from millrace.llm.unigram_counts import MARK, UnigramCounter, count_tokens, words_of, zipf_vocabulary


def library(pieces):
    tokenizer = Tokenizer(models.Unigram(pieces, 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="always", split=True)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def pieces():
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    return zipf_vocabulary([model.id_to_piece(i) for i in range(model.get_piece_size())])


def test_equals_the_library(pieces):
    rng = random.Random(2)
    texts = ["", "  ", "a  b", " a b ", "\n\n", "日本 語語語 ☃☃", "<unk> <s>x", "▁a ▁▁b", "\t x y", "x" * 3000]
    texts += ["".join(rng.choice("abcdeth in ▁日☃☄\n") for _ in range(rng.randrange(40))) for _ in range(2000)]
    counter, want = UnigramCounter(pieces, 0), library(pieces)
    for text in texts:
        assert sum(map(counter.count, words_of(text))) == want(text), text


def test_ties_fall_alike():
    rng = random.Random(8)
    for _ in range(200):
        pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 5))) for _ in range(12)}
        own = [("<unk>", 0.0)] + [(p, -float(rng.randrange(1, 4))) for p in sorted(pieces)]
        counter, want = UnigramCounter(own, 0), library(own)
        for _ in range(15):
            text = "".join(rng.choice("aabbc ") for _ in range(rng.randrange(14)))
            assert sum(map(counter.count, words_of(text))) == want(text), (own, text)


def test_rows(documents, pieces):
    want = library(pieces)
    rows = [(1, "one two"), (2, None), (3, ""), (1, "one two"), (None, "x"), (4, "long text " * 50_000)]
    got = count_tokens(documents(rows), pieces, 0).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(map(tuple, got), key=key) == sorted(((i, want(t or "")) for i, t in rows), key=key)
    assert count_tokens(documents([]), pieces, 0).collect() == []
