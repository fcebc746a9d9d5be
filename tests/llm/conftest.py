import pytest


@pytest.fixture
def documents(spark):
    """Documents from (id, text) or (id, text, lang, source) rows, with columns that clash
    with names the operators make."""

    def build(rows):
        full = [(*r, None, None)[:4] if len(r) == 2 else r for r in rows]
        data = [(i, t, g, s, None if t is None else len(t), "x", 0.5, [1]) for i, t, g, s in full]
        shape = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, "
            "size string, score double, ids array<int>"
        )
        return spark.createDataFrame(data, shape)

    return build
