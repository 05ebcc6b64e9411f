"""Bitmaps of item codes against plain sets and joins."""

import random

import pytest

from ludex.operators import bitmaps as bm
from ludex.operators.indexing import dense_index, extend_index

ITEMS = 70_000  # three chunks


@pytest.fixture(scope="module")
def codes(spark):
    return spark.range(ITEMS).selectExpr("id * 3 as item", "id as code")


def _rows(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item long")


def _owned():
    rng = random.Random(5)
    rows = [(u, 3 * rng.randrange(ITEMS)) for u in range(40) for _ in range(u)]
    rows += [(99, 3 * i) for i in range(0, ITEMS, 2)]         # a user of half of all items
    rows += [(7, 0), (7, 189), (7, 192), (7, 3 * 32767), (7, 3 * 32768)]  # ends of words, chunks
    return rows + rows[:50]                                   # repeated rows


def test_members_are_the_owned_items(spark, codes):
    rows = _owned()
    maps = bm.bitmaps(_rows(spark, rows), codes)
    found = {(r.user_id, r.code * 3) for r in bm.members(maps).collect()}
    assert found == set(rows)
    assert maps.selectExpr("max(size(words)) as n").first().n <= bm.CHUNK_BITS // bm.WORD_BITS
    assert bm.members(maps).count() == len(set(rows))
    sizes = {r.user_id: r.n for r in maps.groupBy("user_id").agg(
        {"chunk": "count"}).selectExpr("user_id", "`count(chunk)` as n").collect()}
    assert sizes[99] == 3


def test_semi_and_anti_join(spark, codes):
    rows = _owned()
    owned = _rows(spark, rows)
    rng = random.Random(6)
    asked = [(rng.randrange(45), 3 * rng.randrange(ITEMS)) for _ in range(300)] + rows[::7]
    asked += [(99, 3 * i) for i in range(0, ITEMS, 999)]
    asked += [(None, 3), (3, None), (None, None), (3, 1)]      # NULLs, an item without a code
    asked += asked[:20]
    df, maps = _rows(spark, asked).selectExpr("*", "1 as chunk", "2 as words"), None
    maps = bm.bitmaps(owned, codes)
    for got, kind in ((bm.having(df, maps, codes), "left_semi"), (bm.lacking(df, maps, codes), "left_anti")):
        want = df.join(owned, ["user_id", "item"], kind).select(df.columns)
        assert got.columns == df.columns
        key = lambda r: str(tuple(r))
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_sizes_and_union(spark, codes):
    rows = _owned()
    left, right = rows[::2], rows[1::3] + [(500, 3)]
    a, b = (bm.bitmaps(_rows(spark, r), codes) for r in (left, right))
    got = {r.user_id: (r.n_left, r.n_right, r.n_both) for r in bm.set_sizes(a, b).collect()}
    la, lb = set(left), set(right)
    want = {u: tuple(sum(x[0] == u for x in s) for s in (la, lb, la & lb))
            for u in {x[0] for x in la | lb}}
    assert got == want
    assert {(r.user_id, r.code * 3) for r in bm.members(bm.unite(a, b)).collect()} == la | lb


def test_codes_that_grow(spark):
    """Bitmaps of an old log stay right when the codes are extended."""
    old, new = [(1, 10), (1, 30), (2, 20)], [(1, 15), (2, 20), (3, 5)]
    first = dense_index(_rows(spark, old), "item")
    second = extend_index(first, _rows(spark, new), "item")
    both = bm.unite(bm.bitmaps(_rows(spark, old), first), bm.bitmaps(_rows(spark, new), second))
    name = {r.code: r.item for r in second.collect()}
    assert {(r.user_id, name[r.code]) for r in bm.members(both).collect()} == set(old + new)


def test_nulls_and_empty(spark, codes):
    none = bm.bitmaps(_rows(spark, [(None, 3), (1, None), (1, 1)]), codes)
    assert none.count() == 0
    empty = bm.bitmaps(_rows(spark, []), codes)
    df = _rows(spark, [(1, 3), (None, None)])
    assert bm.lacking(df, empty, codes).count() == 2 and bm.having(df, empty, codes).count() == 0
    assert bm.set_sizes(empty, none).count() == 0
    no_codes = codes.limit(0)
    assert bm.lacking(df, empty, no_codes).count() == 2
