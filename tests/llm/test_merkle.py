import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle
from millrace.llm.shared import ASCII_LOWER

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    """Root and, for each leaf, place and siblings on every level, from the whole tree."""
    paths, under, nodes = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        above, below = [], []
        for start in range(0, len(nodes), 16):
            run = nodes[start : start + 16]
            for place in range(len(run)):
                for i in under[start + place]:
                    paths[i].append((place, run[:place] + run[place + 1 :]))
            above.append(H(run))
            below.append([i for part in under[start : start + 16] for i in part])
        nodes, under = above, below
    return nodes[0], paths


def brute(rows):
    """(doc_id, leaf, subroot, root, witness) of (doc_id, text, lang, source, n_chars) rows."""
    trees = {}
    for row in rows:
        doc, text, lang, source, n = row
        trees.setdefault(source, []).append((doc is not None, doc or 0, H(map(field, (doc, source, lang, n, text))), row))
    found, tops = [], []
    for source in sorted(trees, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(trees[source], key=lambda x: x[:3])
        root, paths = plain_tree([leaf for _, _, leaf, _ in leaves])
        found += [(row, leaf, root, path, len(tops)) for (_, _, leaf, row), path in zip(leaves, paths)]
        tops.append(root)
    if not tops:
        return []
    root, paths = plain_tree(tops)
    return sorted(((row[0], leaf, top, root, path + paths[i]) for row, leaf, top, path, i in found), key=str)


def unpacked(witness):
    return [(level.place, [level.siblings[i : i + 32].hex() for i in range(0, len(level.siblings), 32)]) for level in witness]


def check(df):
    made = merkle.merkle_manifest(df, FIELDS).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, unpacked(r.witness)) for r in made), key=str) == brute(
        [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    )


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 255, 256, 257, 272, 4095, 4096, 4097, 4113])
def test_appender_equals_whole_tree(size):
    leaves = [sha256(b"%d" % i).digest() for i in range(size)]
    root, paths = plain_tree([x.hex() for x in leaves])
    tree = merkle.Appender()
    for leaf in leaves:
        tree.append(leaf)
    found, witnesses = tree.close(None)
    assert found.hex() == root
    for i in range(0, size, 7):
        rest = [(p, [s[j : j + 32].hex() for j in range(0, len(s), 32)]) for p, s in witnesses[i // 16]]
        assert rest == paths[i][1:]


def test_trees_of_many_sizes(spark, documents):
    rows = [(i, f"Text {i}", "aa", f"s{size}") for size in (1, 2, 16, 17, 256, 257) for i in range(size)]
    rows += [(5, "lone", "aa", None), (-1, "é" * 9, None, "s2"), (3, None, "aa", "S2"), (3, "", "aa", "S2")]
    check(documents(rows))


def test_many_sources(spark, documents):
    check(documents([(i, "x", None, f"s{i % 300}") for i in range(900)]))


def test_blocks(spark):
    """Several blocks of one tree, the last with a single leaf, next to a small tree."""
    size = 2 * merkle.BLOCK + 1
    df = spark.range(size + 40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("T"), F.col("id").cast("string")).alias("text"), F.lit("aa").alias("lang"),
        F.when(F.col("id") < size, "big").otherwise("small").alias("source"), F.lit(4).cast("long").alias("n_chars"),
    )
    check(df)


def test_odd_rows(spark, documents):
    """Nulls, equal rows, repeated ids with other texts, long texts; columns that clash."""
    rows = [(None, "a", "aa", "s"), (None, None, None, None), (1, "b", "aa", "s"), (1, "b", "aa", "s"), (1, "c", "aa", "s")]
    rows += [(2, "word " * 200_000, "aa", "s"), (7, "", "", "")]
    df = documents(rows)
    for name in ("tree", "pos", "n", "digest", "row", "run", "leaf", "root", "witness", "_task"):
        df = df.withColumn(name, F.lit("x"))
    check(df)


def test_equal_rows_are_leaves_of_their_own(spark, documents):
    check(documents([(1, "same", "aa", "s")] * 40))


def test_empty_table(spark, documents):
    made = merkle.merkle_manifest(documents([]), FIELDS)
    assert made.columns == ["doc_id", "leaf", "subroot", "root", "witness"] and made.collect() == []


def test_tampering_shows(spark, documents):
    rows = [(i, ["Upper", "lower", None][i % 3], "aa", f"s{i % 3}") for i in range(60)]
    df = documents(rows).withColumn("bad", F.lower("text"))
    made = merkle.merkle_manifest(df, FIELDS, carry={"bad": merkle.leaf_of(*FIELDS[:-1], "bad")})
    made = made.withColumn("folded", merkle.folded(merkle.hex_of("bad"), "witness"))
    made = made.withColumn("proof", merkle.proof_of("witness"))
    for row in made.collect():
        siblings = unpacked(row.witness)
        assert row.proof == H(x for _, level in siblings for x in level)
        digest = row.bad.hex()
        for place, level in siblings:
            digest = H(level[:place] + [digest] + level[place:])
        assert row.folded == digest and (digest == row.root) == (row.doc_id % 3 > 0)


def test_query_columns(spark):
    from millrace.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    made = QUERIES["op13_merkle_witnesses"](spark, sf).collect()
    assert len(made) == len(docs)
    for row in made:
        doc = docs[row.doc_id]
        hit = zlib.crc32(str(row.doc_id).encode()) % 5 == 0
        changed = hit and doc.text is not None and doc.text.encode() != doc.text.encode().translate(ASCII_LOWER)
        assert row.verified == (not changed) == (row.folded_root == row.root)
