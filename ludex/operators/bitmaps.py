"""Sets of items per key as compressed bitmaps of item codes.

The dense codes of a key's items are cut into chunks of ``CHUNK_BITS`` codes; a
chunk is one row with its non-empty 64-bit words (at most 512 of them, so a key
that holds every item has many rows of bounded size). A semi or anti join is then
a join on (key, chunk) and a bit test, unions and intersections are bit
operations on equal words. Where a key holds many items this shuffles a row per
chunk instead of one per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludex.session import stage_only

CHUNK_BITS = 1 << 15
WORD_BITS = 64
_CHUNK, _WORD, _BIT, _CODE = "_bm_chunk", "_bm_word", "_bm_bit", "_bm_code"


def _place(code: Column) -> list[Column]:
    """Chunk, word of the chunk, and the bit in the word of a code."""
    inside = code.bitwiseAND(F.lit(CHUNK_BITS - 1))
    return [F.floor(code / CHUNK_BITS).cast("bigint").alias(_CHUNK),
            F.floor(inside / WORD_BITS).cast("int").alias(_WORD),
            F.call_function("shiftleft", F.lit(1).cast("bigint"),
                            inside.bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")).alias(_BIT)]


def _gather(words: DataFrame, key: str) -> DataFrame:
    """(key, chunk, word, bits) of one row per word -> one row per chunk."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(_WORD).alias("at"), "bits")))
    return (words.groupBy(key, _CHUNK).agg(F.map_from_entries(packed).alias("words"))
            .withColumnRenamed(_CHUNK, "chunk"))


def bitmaps(rows: DataFrame, codes: DataFrame, key: str = "user_id", item: str = "item",
            code: str = "code") -> DataFrame:
    """``rows`` (key, item) -> key, chunk, words (map of word number to its 64
    bits): the items each key has, by the codes of ``codes`` (item, code).

    A repeated row sets the same bit; rows with a NULL key, and items that are
    NULL or have no code, are in no bitmap. An empty table gives an empty table.
    Words are made with a map-side combined ``bit_or``, so a hot key costs as
    many rows as it has words. Eager: written, so that joins with it can be
    split."""
    def build() -> DataFrame:
        named = codes.select(F.col(item).alias("_bm_item"), F.col(code).alias(_CODE))
        coded = rows.select(key, item).where(F.col(key).isNotNull()).join(
            named, F.col(item) == F.col("_bm_item"))
        words = (coded.select(key, *_place(F.col(_CODE))).groupBy(key, _CHUNK, _WORD)
                 .agg(F.bit_or(_BIT).alias("bits")))
        return _gather(words, key)

    return stage_only(build, "bitmaps")


def _tested(df: DataFrame, maps: DataFrame, codes: DataFrame, key: str, item: str,
            code: str) -> DataFrame:
    """``df`` with ``_bm_has``: whether the bitmap of its key has its item."""
    named = codes.select(F.col(item).alias("_bm_item"), F.col(code).alias(_CODE))
    placed = df.join(named, F.col(item) == F.col("_bm_item"), "left").select(
        *df.columns, *_place(F.col(_CODE)))
    held = maps.select(F.col(key).alias("_bm_key"), F.col("chunk").alias("_bm_of"), "words")
    held = held.withColumnRenamed("words", "_bm_words")
    met = placed.join(held, (F.col(key) == F.col("_bm_key"))
                      & (F.col(_CHUNK) == F.col("_bm_of")), "left")
    bits = F.col("_bm_words")[F.col(_WORD)]
    return met.select(*df.columns, F.coalesce(bits.bitwiseAND(F.col(_BIT)) != 0, F.lit(False))
                      .alias("_bm_has"))


def having(df: DataFrame, maps: DataFrame, codes: DataFrame, key: str = "user_id",
           item: str = "item", code: str = "code") -> DataFrame:
    """Rows of ``df`` whose item is in the bitmap of their key: a semi join.
    Repeated rows stay; NULL keys and items without a code have no match."""
    return _tested(df, maps, codes, key, item, code).where("_bm_has").drop("_bm_has")


def lacking(df: DataFrame, maps: DataFrame, codes: DataFrame, key: str = "user_id",
            item: str = "item", code: str = "code") -> DataFrame:
    """The other rows of ``df``: an anti join."""
    return _tested(df, maps, codes, key, item, code).where("not _bm_has").drop("_bm_has")


def unite(left: DataFrame, right: DataFrame, key: str = "user_id") -> DataFrame:
    """Bitmaps of the items in either: new rows of a log enter without a second
    pass over the old ones (codes grow by ``extend_index``)."""
    both = left.unionByName(right).select(
        key, F.col("chunk").alias(_CHUNK), F.explode("words").alias(_WORD, _BIT))
    return _gather(both.groupBy(key, _CHUNK, _WORD).agg(F.bit_or(_BIT).alias("bits")), key)


def size(words: Column) -> Column:
    """Items of a chunk."""
    return F.aggregate(F.transform(F.map_values(words), lambda b: F.bit_count(b).cast("bigint")),
                       F.lit(0).cast("bigint"), lambda a, n: a + n)


def set_sizes(left: DataFrame, right: DataFrame, key: str = "user_id") -> DataFrame:
    """Per key of either: items of ``left``, of ``right`` and of both (n_left,
    n_right, n_both), from the words alone."""
    a = left.select(key, "chunk", F.col("words").alias("_a"))
    b = right.select(key, "chunk", F.col("words").alias("_b"))
    shared = F.map_zip_with("_a", "_b", lambda _, x, y: F.coalesce(x.bitwiseAND(y), F.lit(0)))
    count = lambda c: F.coalesce(F.sum(size(c)), F.lit(0))
    return a.join(b, [key, "chunk"], "full").groupBy(key).agg(
        count(F.col("_a")).alias("n_left"), count(F.col("_b")).alias("n_right"),
        count(shared).alias("n_both"))


def members(maps: DataFrame, key: str = "user_id") -> DataFrame:
    """The codes of the bitmaps again: one row (key, code) per item."""
    words = maps.select(key, "chunk", F.explode("words").alias(_WORD, _BIT))
    bits = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)),
                    lambda i: F.getbit(F.col(_BIT), i) == 1)
    return words.select(key, "chunk", _WORD, F.explode(bits).alias(_BIT)).select(
        key, (F.col("chunk") * CHUNK_BITS + F.col(_WORD) * WORD_BITS + F.col(_BIT)).alias("code"))
