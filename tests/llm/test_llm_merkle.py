import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ludex.llm import merkle as mk


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests):
    """(root, proofs as lists of (left, right)) of one tree, level by level."""
    proofs, where, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for k, node in enumerate(where):
            other = node ^ 1
            if other < len(level):
                proofs[k].append((level[other], "") if other < node else ("", level[other]))
            else:
                proofs[k].append(("", ""))
            where[k] = node >> 1
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return level[0], proofs


def brute(rows):
    groups = defaultdict(list)
    for key, group, leaf in rows:
        groups[group].append((key is not None, key or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: tree([r[2] for r in sorted(groups[g])]) for g in names}
    root, high = tree([low[g][0] for g in names])
    out = []
    for g, above in zip(names, high, strict=True):
        for (some, key, leaf), proof in zip(sorted(groups[g]), low[g][1], strict=True):
            text = "".join("L" + a + "," if a else "R" + b + "," if b else "-,"
                           for a, b in proof + above)
            out.append((key if some else None, g, leaf, low[g][0], root, text))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in map(str, r)))


ROWS = [(i * 7 % 101, "en", h(str(i))) for i in range(101)] + [
    (1, "de", h("one")), (None, "fr", h("n1")), (None, "fr", h("n2")), (5, "fr", h("a")),
    (5, "fr", h("b")), (5, "fr", h("b")), (9, None, h("x")), (8, None, h("y")), (3, "", h("e")),
    (2, "é", h("u")), (2, "\U0001f600", h("v"))]


@pytest.mark.parametrize("bits", [1, 3, 10])
def test_equals_brute_force(spark, bits):
    df = spark.createDataFrame([(*r, "k", 1) for r in ROWS],
                               "doc_id bigint, lang string, leaf string, g string, i int")
    found = mk.merkle_manifest(df, "doc_id", "lang", block_bits=bits)
    got = [tuple(r[c] for c in ("doc_id", "lang", "leaf", "subroot", "root", "proof"))
           for r in found.collect()]
    assert order(got) == order(brute(ROWS))
    bad = found.where(mk.folded(F.col("leaf"), F.col("proof")) != F.col("root"))
    assert bad.count() == 0


def test_one_leaf_and_empty(spark):
    schema = "doc_id bigint, lang string, leaf string"
    one = mk.merkle_manifest(spark.createDataFrame([(1, None, "ab")], schema), "doc_id", "lang")
    row = one.withColumn("f", mk.folded(F.col("leaf"), F.col("proof"))).first()
    assert (row["subroot"], row["root"], row["proof"], row["f"]) == ("ab", "ab", "", "ab")
    assert mk.merkle_manifest(spark.createDataFrame([], schema), "doc_id", "lang").count() == 0


def test_damage_is_found(spark):
    rows = [(i, "en", h(str(i)), h(str(i), "!") if i == 11 else h(str(i))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, leaf string, seen string")
    found = mk.merkle_manifest(df, "doc_id", "lang", carry=("seen",), block_bits=2)
    wrong = found.where(mk.folded(F.col("seen"), F.col("proof")) != F.col("root"))
    assert [r["doc_id"] for r in wrong.collect()] == [11]


def test_leaf_fields(spark):
    row = spark.createDataFrame([(None, "é:", 12, "")], "a string, b string, n bigint, t string")
    got = row.select(mk.leaf_digest("a", "b", "n", "t")).first()[0]
    assert got == h("-", "3:é:", "2:12", "0:")


def test_queue_order():
    labels = [(lv, node) for lv, node, _ in mk.sweep_up(4, list("abcdefg"), 3)]
    assert labels == sorted(labels)
