import inspect
from hashlib import sha256

import pytest

from corpus_pipeline import COLUMNS, STAGES, run
from millrace.llm.queries import ORACLES

from .test_bpe import PATH, Tokenizer
from .test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages(spark):
    assert [n for n, _ in STAGES] == ["language_id", "ngram_jaccard_join", "secret_scans", "source_mixing", "bpe_encoding"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in STAGES)


def test_one_document_of_each_group_stays(spark, documents, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000, rows[0][1]), (rows[1][0], rows[1][1]), (None, rows[2][1]), (1001, None), (1002, "")]
    want = sorted({d for d, _, c in brute(rows, 5, "0.8") if d == c and d is not None})
    out = STAGES[1][1](spark, documents(rows), SF)
    got = [r.doc_id for r in out.collect()]
    assert out.columns == COLUMNS and sorted(d for d in got if d is not None) == want and got.count(None) == 1


def test_copies_between_both_measures_go(spark, documents):
    def similarity(a, b, n):
        x, y = ({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for w in (a, b))
        return len(x & y) / len(x | y)

    # Ten scattered words of 500: 446/546 of the runs of five, 468/528 of the runs of three.
    base = [f"w{i}" for i in range(500)]
    near = [f"new{i}" if i % 48 == 24 and i < 480 else w for i, w in enumerate(base)]
    far = [f"new{i}" if i % 40 == 20 else w for i, w in enumerate(base)]
    assert 0.8 <= similarity(base, near, 5) < 0.9 and similarity(base, near, 3) < 0.9
    assert similarity(base, far, 5) < 0.8
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    out = STAGES[1][1](spark, documents(rows), SF)
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_odd_rows_pass_every_stage(spark, documents, tmp_path):
    text = "kala maka tala naka lasa "
    rows = [(i, text * (i % 9 + 1) + str(i), "aa", ["a", None][i % 2]) for i in range(60)]
    rows += [(100, None, "aa", "a"), (101, "", None, None), (102, "12 3", "aa", "a"), (1, rows[1][1], "aa", None), (None, text, "aa", "b"),
             (103, text * 20_000, "aa", "b"), (104, text + "token = abcdef0123456789", "aa", "a")]
    now = documents(rows)
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == COLUMNS if number < 4 else now.columns[:2] == ["doc_id", "n_tokens"]
        assert now.count() > 0
        if name == "language_id":
            assert not {100, 101, 102} & {r.doc_id for r in now.select("doc_id").collect()}
        if name == "secret_scans":
            assert [r.text for r in now.where("doc_id = 104").collect()] == [text + "[SECRET]"]


def test_empty_table(spark, documents, tmp_path):
    now = documents([])
    for name, stage in STAGES:
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    assert now.count() == 0


def test_run(spark, docs, tmp_path):
    """Every row of run(): stage by stage, with brute force, SQL and the library in the place
    of the near copies, the mix and the encoding."""
    import duckdb

    known = STAGES[0][1](spark, docs, SF)
    rows = [(r.doc_id, r.text) for r in known.collect()]
    kept = [d for d, _, c in brute(rows, 5, "0.8") if d == c]
    clean = STAGES[2][1](spark, known.where(known.doc_id.isin(kept)), SF)
    clean.write.parquet(str(tmp_path / "clean"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/clean/*.parquet'")
    taken = {d: n // size for d, size, _, _, n in db.execute(ORACLES["op7_mixing"]).fetchall() if size}
    texts = {r.doc_id: r.text for r in clean.collect()}
    library = Tokenizer.from_file(PATH)
    want = []
    for doc, times in taken.items():
        ids = library.encode(texts[doc], add_special_tokens=False).ids
        want += [(doc, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())] * times
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in run(spark, SF).collect()) == sorted(want) and want
