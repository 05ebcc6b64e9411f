"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf, every group (language) a binary hash tree over its leaves in
key order, and one more tree joins the groups' roots. A tree is evaluated as a
graph whose nodes are labelled (level, index): each node sends its digest to its
parent's label, a priority queue hands the messages out in label order, and a
node is hashed once all of its children have been delivered. A second sweep in
reversed label order hands each node the rest of the proof above it, until the
leaves hold whole proofs.

The queue is external: a block of ``2**block_bits`` neighbouring nodes is swept
in one task, the messages that leave a block are written to a table and are
the leaves of the next round, so n leaves take log(n) / ``block_bits`` rounds
and no task, group or driver holds more than a block of one group's nodes.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludex.llm.common import read_table
from ludex.llm.positions import group_positions
from ludex.session import stage_table

# A block has 2**BLOCK_BITS nodes: the most that one sweep holds.
BLOCK_BITS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Every TAMPER_EVERY-th document (by checksum of its id) is damaged in the query.
TAMPER_EVERY = 7


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value: Column | str) -> Column:
    """A field of a leaf: ``-`` for NULL, else its length in bytes, ``:`` and
    the value."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column | str) -> Column:
    """Digest of a row from its field values, in order."""
    return F.sha2(F.concat(*map(encoded, values)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and a ``proof`` of ``merkle_manifest`` lead to."""
    def step(below: Column, entry: Column) -> Column:
        side, other = F.substring(entry, 1, 1), F.substring(entry, 2, 64)
        return F.sha2(F.concat(F.when(side == "L", other).otherwise(F.lit("")), below,
                               F.when(side == "R", other).otherwise(F.lit(""))), 256)

    return F.aggregate(F.filter(F.split(proof, ","), lambda e: e != ""), leaf, step)


def proof_digest(proof: Column) -> Column:
    """Digest of the siblings of a proof, without their sides."""
    return F.sha2(F.translate(proof, "LR-,", ""), 256)


def levels_of(n: int, block_bits: int) -> int:
    """Levels that a block climbs in a tree of ``n`` nodes: all, if they fit."""
    return min(block_bits, (n - 1).bit_length())


def sweep_up(first: int, digests: list[str], levels: int) -> Iterator[tuple[int, int, str]]:
    """(level, index, digest) of every node ``levels`` levels up and below, in
    label order, over neighbouring nodes from index ``first`` on."""
    queue = [(0, first + k, first + k, d) for k, d in enumerate(digests)]  # in order: a heap
    while queue:
        level, node, _, digest = heapq.heappop(queue)
        if level:
            children = [digest]
            while queue and queue[0][:2] == (level, node):
                children.append(heapq.heappop(queue)[3])
            digest = _digest(children)
        yield level, node, digest
        if level < levels:
            heapq.heappush(queue, (level + 1, node >> 1, node, digest))


def sweep_down(first: int, digests: list[str], levels: int, above: str) -> list[str]:
    """The proof of each of the neighbouring nodes, given the proof ``above``
    of the node ``levels`` levels up: the upward sweep reversed."""
    nodes = list(sweep_up(first, digests, levels))
    digest_of = {(level, node): d for level, node, d in nodes}
    proof = {(levels, first >> levels): above}
    for level, node, _ in reversed(nodes):
        rest = proof.pop((level, node))
        if not level:
            proof[-1, node] = rest
            continue
        left, right = (level - 1, 2 * node), (level - 1, 2 * node + 1)
        if left in digest_of and right in digest_of:
            proof[left] = f"R{digest_of[right]},{rest}"
            proof[right] = f"L{digest_of[left]},{rest}"
        else:
            proof[left if left in digest_of else right] = f"-,{rest}"
    return [proof[-1, first + k] for k in range(len(digests))]


def _up(block_bits: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        first, n = table.column("i")[0].as_py(), table.column("n")[0].as_py()
        levels = levels_of(n, block_bits)
        *_, (_, node, digest) = sweep_up(first, table.column("digest").to_pylist(), levels)
        left = -(-n >> levels)
        return pa.table({"g": table.column("g")[:1], "i": pa.array([node], pa.int64()),
                         "n": pa.array([left], pa.int64()), "digest": [digest]})

    return run


def _down(block_bits: int):
    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("i")
        first, n = nodes.column("i")[0].as_py(), nodes.column("n")[0].as_py()
        proofs = sweep_down(first, nodes.column("digest").to_pylist(), levels_of(n, block_bits),
                            above.column("proof")[0].as_py())
        nodes = nodes.append_column("proof", pa.array(proofs, pa.string()))
        for name in ("top", "root"):
            same = pa.array([above.column(name)[0].as_py()] * len(proofs), pa.string())
            nodes = nodes.append_column(name, same)
        return nodes

    return run


def _climb(nodes: DataFrame, block_bits: int) -> list[DataFrame]:
    """The tables of nodes (g, i, n, digest) round by round, up to one per g."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1 or len(rounds) == 1:
        block = F.shiftright("i", block_bits).alias("block")
        up = rounds[-1].select("g", "i", "n", "digest").groupBy("g", block).applyInArrow(
            _up(block_bits), "g string, i bigint, n bigint, digest string")
        rounds.append(stage_table(up, "merkle"))
        most = -(-most >> block_bits)
    return rounds


def _descend(rounds: list[DataFrame], above: DataFrame, block_bits: int) -> DataFrame:
    """The nodes of the first round with their proof, top and root, from
    ``above`` (g, i, proof, top, root): those of the last round."""
    for nodes in reversed(rounds[:-1]):
        schema = T.StructType(nodes.schema.fields + [T.StructField(c, T.StringType())
                                                     for c in ("proof", "top", "root")])
        above = nodes.groupBy("g", F.shiftright("i", block_bits).alias("block")).cogroup(
            above.select("g", F.col("i").alias("block"), "proof", "top", "root")
            .groupBy("g", "block")).applyInArrow(_down(block_bits), schema)
    return above


def merkle_manifest(leaves: DataFrame, key: str, group: str, leaf: str = "leaf",
                    carry: tuple[str, ...] = (), block_bits: int = BLOCK_BITS) -> DataFrame:
    """``leaves`` (key, group, leaf: hex digest) -> one row per leaf: key, group,
    leaf, subroot (of its group), root (of all) and proof: from the leaf to the
    root, each entry followed by a comma: ``L`` or ``R`` and the sibling on that
    side, or ``-`` where the node is alone; then the columns ``carry``. Groups
    are ordered NULL first, then by the bytes of their name. ``folded`` checks a
    proof.

    Cases: a NULL key comes first in its group; equal keys are ordered by leaf;
    repeated rows are leaves of their own. A group of one leaf has it as
    subroot, one group's subroot is the root (with an empty proof if that is
    one leaf). An empty table gives an empty table. Other columns are ignored.
    Eager: leaves, positions and rounds are written to the shared folder."""
    extra = {f"c{k}": c for k, c in enumerate(carry)}
    # The order of g as a string is NULL first, then bytewise.
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    held = stage_table(leaves.select(
        F.col(key).alias("k"), g.alias("g"), F.col(group).alias("grp"),
        F.col(leaf).alias("digest"), *[F.col(c).alias(x) for x, c in extra.items()]), "leaves")
    sizes = stage_table(held.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "merkle")
    order = [F.col("k").asc_nulls_first(), F.col("digest").asc()]
    placed = stage_table(group_positions(held, ["g"], order, "i").join(sizes, "g"), "merkle")

    rounds = _climb(placed, block_bits)
    # The groups' roots are the leaves of one more tree.
    tops = stage_table(group_positions(rounds[-1].select("g", "digest"), [],
                                       [F.col("g").asc()], "i"), "merkle")
    many = tops.agg(F.count(F.lit(1))).scalar()
    upper = _climb(stage_table(tops.select(
        F.lit("").alias("g"), "i", many.alias("n"), "digest", F.col("g").alias("of")), "merkle"),
        block_bits)
    root = upper[-1].select("g", "i", F.lit("").alias("proof"), F.lit("").alias("top"),
                            F.col("digest").alias("root"))
    heads = stage_table(_descend(upper, root, block_bits).select(
        F.col("of").alias("g"), F.lit(0).cast("bigint").alias("i"), "proof",
        F.col("digest").alias("top"), "root"), "merkle")
    return _descend(rounds, heads, block_bits).select(
        F.col("k").alias(key), F.col("grp").alias(group), F.col("digest").alias(leaf),
        F.col("top").alias("subroot"), "root", "proof",
        *[F.col(x).alias(c) for x, c in extra.items()])


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` by lang. Where ``TAMPER_EVERY`` divides the
    crc32 of the id, the leaf that is checked is of a row with 1 added to n_chars."""
    docs = read_table(spark, sf_dir, "documents").select(*FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    more = F.col("n_chars").cast("decimal(20,0)") + F.lit(1)
    intact = leaf_digest(*FIELDS)
    changed = leaf_digest(*[more if c == "n_chars" else F.col(c) for c in FIELDS])
    leaves = docs.select("doc_id", "lang", intact.alias("leaf"),
                         F.when(hit, changed).otherwise(intact).alias("checked"))
    found = merkle_manifest(leaves, "doc_id", "lang", carry=("checked",))
    found = found.withColumn("folded_root", folded(F.col("checked"), F.col("proof")))
    return found.select("doc_id", "leaf", "subroot", "root",
                        proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


OP12_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, lang,
    list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text,
                    CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)],
      lambda v: coalesce(strlen(v) || ':' || v, '-')) AS f,
    xor(list_reduce([4294967295] || flatten(list_transform(
          range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: list_transform(range(0, 8),
          lambda j: CAST((ord(CAST(doc_id AS VARCHAR)[i]) >> CAST(j AS INTEGER)) & 1 AS BIGINT)))),
        lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)),
        4294967295) % 7 = 0 AS hit
  FROM documents),
leaves AS (
  SELECT doc_id, lang, coalesce('=' || lang, '') AS g,
    sha256(f[1] || f[2] || f[3] || f[4] || f[5]) AS leaf,
    sha256(f[1] || f[2] || f[3] || CASE WHEN hit THEN f[6] ELSE f[4] END || f[5]) AS checked,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM doc),
low AS (
  SELECT g, 0 AS lv, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, lv + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM low WHERE n > 1 GROUP BY g, lv, i // 2, n),
tops AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS j, count(*) OVER () AS m
  FROM low WHERE n = 1),
high AS (
  SELECT 0 AS lv, j AS i, m AS n, subroot AS h FROM tops
  UNION ALL
  SELECT lv + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM high WHERE n > 1 GROUP BY lv, i // 2, n),
walk AS (
  SELECT l.doc_id, l.g, l.leaf, l.checked AS h, '' AS p, 0 AS lv, l.i, l.n, FALSE AS up
  FROM leaves l
  UNION ALL
  SELECT w.doc_id, w.g, w.leaf,
    CASE WHEN w.n = 1 THEN w.h
         WHEN s.h IS NULL THEN sha256(w.h)
         WHEN w.i % 2 = 0 THEN sha256(w.h || s.h) ELSE sha256(s.h || w.h) END,
    w.p || CASE WHEN w.n = 1 THEN '' ELSE coalesce(s.h, '') END,
    CASE WHEN w.n = 1 THEN 0 ELSE w.lv + 1 END,
    CASE WHEN w.n = 1 THEN t.j ELSE w.i // 2 END,
    CASE WHEN w.n = 1 THEN t.m ELSE (w.n + 1) // 2 END,
    w.up OR w.n = 1
  FROM walk w JOIN tops t ON t.g = w.g
  LEFT JOIN (SELECT g, lv, i, h, FALSE AS up FROM low
             UNION ALL SELECT NULL, lv, i, h, TRUE FROM high) s
    ON s.up = w.up AND s.g IS NOT DISTINCT FROM CASE WHEN w.up THEN NULL ELSE w.g END
   AND s.lv = w.lv AND s.i = xor(w.i, 1) AND w.n > 1
  WHERE w.n > 1 OR NOT w.up)
SELECT w.doc_id, w.leaf, t.subroot, r.h AS root, sha256(w.p) AS proof_sha256,
       w.h AS folded_root, w.h = r.h AS verified
FROM walk w JOIN tops t ON t.g = w.g, (SELECT h FROM high WHERE n = 1) r
WHERE w.up AND w.n = 1
"""
