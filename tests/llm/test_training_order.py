import random

import numpy as np
import public_tokenizers
import pytest

from millrace.llm.queries import RANK_PATTERN, vocabulary
from millrace.llm.training_order import TextCoder, read_slots, slots_of, training_order

PATH = vocabulary("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("count", [1, 2, 3, 5, 16, 17, 255, 1000, 4097])
def test_slots_are_a_keyed_permutation(count):
    orders = {key: tuple(slots_of(np.arange(count), count, key).tolist()) for key in (1, 2, 99)}
    assert all(sorted(o) == list(range(count)) for o in orders.values())
    assert count < 16 or len(set(orders.values())) == 3


def test_pattern_cuts_like_the_public_one():
    ours, rng = TextCoder(PATH, RANK_PATTERN), random.Random(3)
    public = TextCoder(PATH, public_tokenizers.PATTERN)
    for _ in range(4000):
        text = "".join(rng.choice("ab c\n\t é'sdtrevml1.,\u00a0٣") for _ in range(rng.randrange(25)))
        assert ours.encode(text) == public.encode(text), text


def test_round_trip(spark, documents, tmp_path):
    texts = [f"document {i} " * (i % 40) for i in range(150)] + [None, "", "long " * 20_000, "a  b \n c"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "no id")]
    documents(rows).repartition(5).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    make = lambda key, to: training_order(df, PATH, public_tokenizers.PATTERN, key, 32, 100, 7, str(tmp_path / to))
    manifest, folder = make(5, "out")
    found = manifest.collect()
    assert sorted(r.slot for r in found) == list(range(len(found))) and len(found) > 300
    data = read_slots(folder, 0, len(found), 32, 100)
    coder = TextCoder(PATH, public_tokenizers.PATTERN)
    texts = dict(rows)
    for r in found:
        ids = coder.encode(texts[r.doc_id])[r.piece * 32 : r.piece * 32 + 32]
        assert data[r.slot].tolist() == ids + [7] * (32 - len(ids)) and r.n_tokens == len(ids)
        assert (r.shard, r.place) == divmod(r.slot, 100)
    # Reading resumes at any slot, runs across shards and ends with the data.
    assert (read_slots(folder, 95, 10, 32, 100) == data[95:105]).all()
    assert len(read_slots(folder, len(found) - 3, 10, 32, 100)) == 3
    again, _ = make(5, "again")
    other, _ = make(6, "other")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, found), key=str)
    assert sorted(map(tuple, other.collect()), key=str) != sorted(map(tuple, found), key=str)


def test_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    manifest, _ = training_order(df, PATH, public_tokenizers.PATTERN, 5, folder=str(tmp_path / "out"))
    assert manifest.collect() == []
