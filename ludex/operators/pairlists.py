"""Pairs of items behind a shuffle of compressed lists.

``send`` makes, for each cell (user, item) of the left side, the list of the right
side's cells that it is paired with, and packs the lists of one bucket (a hash of
the left item) in blobs; ``receive`` unpacks a bucket, sums its pairs by (i1, i2)
and hands them on as one row per i1, with all of its pairs or its k most similar
ones. All users' lists of an item lie in one bucket, so the sums are whole.

In a blob items are ascending within a list and stored as steps, values as codes of
the few distinct ones where they are few, all byte by byte (first bytes of all numbers,
then second ones, ...) behind zstandard. Deviations from the user's mean take any
value, so the values are sent with the user's sum and number and centred on arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Pairs that are held at once on either side of the shuffle: one list of a slice
# with a slice, or one item, may be more.
CHUNK_PAIRS = 1 << 21
# Pairs that are summed at once, so that their columns stay in a core's cache.
SUM_PAIRS = 1 << 18
ZSTD_LEVEL = 1
# Cells whose values differ more are sent with the values themselves.
MAX_CODES = 256

SENT = "bucket int, pairs int, blob binary"
SUMS = "i1 bigint, pairs array<struct<i2:bigint,sx:double,sy:double,sxy:double,n_users:bigint>>"
_PAIR = pa.struct([("i2", pa.int64()), ("sx", pa.float64()), ("sy", pa.float64()),
                   ("sxy", pa.float64()), ("n_users", pa.int64())])


def buckets_of(items: np.ndarray, buckets: int) -> np.ndarray:
    """A hash (splitmix64) of the items, modulo ``buckets``."""
    x = items.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(buckets)).astype(np.int64)


def _planes(x: np.ndarray) -> np.ndarray:
    """(width, n) bytes of the 8-byte numbers ``x``, without high bytes that all are 0."""
    raw = x.view(np.uint8).reshape(-1, 8)
    top = int(x.view(np.uint64).max()) if len(x) else 0
    return np.ascontiguousarray(raw[:, :max(1, (top.bit_length() + 7) // 8)].T)


def _numbers(planes: np.ndarray) -> np.ndarray:
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :len(planes)] = planes.T
    return out.reshape(-1).view(np.uint64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), start[1], ..."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


class _Cells:
    """Cells of a list column, flat; ``row`` is the list."""

    def __init__(self, column: pa.Array, order: bool):
        size = column.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        flat = column.flatten()
        self.field = {}
        for i, f in enumerate(flat.type):
            x = flat.field(i)
            if f.name == "top":
                self.field["limited"] = x.is_valid().to_numpy(zero_copy_only=False)
                x = x.fill_null(0)
            self.field[f.name] = x.to_numpy(zero_copy_only=False)
        self.field["row"] = np.repeat(np.arange(len(size)), size)
        if order:
            at = np.lexsort((self.field["item"], self.field["row"]))
            self.field = {k: v[at] for k, v in self.field.items()}
        self.start = np.concatenate([[0], np.cumsum(size)])

    def rows(self, a: int, b: int) -> dict[str, np.ndarray]:
        part = {k: v[self.start[a]:self.start[b]] for k, v in self.field.items()}
        part["row"] = part["row"] - a
        return part


def _lists(left: dict, right: dict, rows: int, only: str) -> tuple[np.ndarray, ...]:
    """Where the list of each left cell begins and ends among the right cells (sorted
    by row and item), and where it holds the cell itself (-1: nowhere)."""
    known, code = np.unique(right["item"], return_inverse=True)
    width = len(known) + 1
    place = right["row"] * width + code
    base = left["row"] * width

    def past(value: np.ndarray) -> np.ndarray:  # the first right cell of the row above it
        return np.searchsorted(place, base + np.searchsorted(known, value, "right"))

    ends = np.searchsorted(place, np.arange(rows + 1) * width)
    low, high = ends[left["row"]], ends[left["row"] + 1]
    above = past(left["item"])
    if only == "half":
        return above, high, np.full(len(base), -1)
    if only == "near":
        high = np.where(left["limited"], past(left["top"]), high)
    elif only == "far":
        low = np.where(left["limited"], past(left["top"]), high)
    own = above - 1
    mine = (own >= low) & (own < high)
    mine[mine] = right["item"][own[mine]] == left["item"][mine]
    return low, high, np.where(mine, own, -1)


def _blobs(left: dict, right: dict, rows: int, only: str, buckets: int, first: int,
           totals: tuple | None, codec: pa.Codec) -> Iterator[tuple[int, int, bytes]]:
    low, high, own = _lists(left, right, rows, only)
    size = high - low - (own >= 0)
    use = np.flatnonzero(left["kept"] & (size > 0))
    to = buckets_of(left["item"][use], buckets)
    order = np.lexsort((left["item"][use], to))
    use, to = use[order], to[order]
    low, high, own, size = low[use], high[use], own[use], size[use]
    i1 = left["item"][use]
    at = _ranges(low, high - low)
    if (own >= 0).any():
        whole = np.ones(len(at), bool)
        begin = np.cumsum(high - low) - (high - low)
        whole[(begin + own - low)[own >= 0]] = False
        at = at[whole]
    head = np.cumsum(size) - size
    i2 = right["item"][at].view(np.uint64)
    step = np.empty_like(i2)
    step[1:] = i2[1:] - i2[:-1]
    step[head] = i2[head] - (i1.view(np.uint64) if only == "half" else np.uint64(first % 2 ** 64))
    # Values of cells without repeated ratings: n is 1 and q is s * s.
    plain = all(bool((x["n"] == 1).all() and (x["q"] == x["s"] * x["s"]).all())
                for x in (left, right))
    values, code = np.unique(right["s"], return_inverse=True)
    coded = plain and len(values) <= MAX_CODES
    sent = [step] if coded else [step, right["s"][at]]
    mine = [i1, size, left["s"][use]]
    if not plain:
        sent += [right["n"][at], right["q"][at]]
        mine += [left["n"][use], left["q"][use]]
    if totals is not None:
        mine += [x[left["row"][use]] for x in totals]
    sent = [_planes(x) for x in sent]
    if coded:
        sent.append(code.astype(np.uint8)[at][None, :])
    cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else []
    cells = np.append(cut, len(to)).astype(np.int64)
    pairs = np.append(head[cut] if len(to) else [], len(at)).astype(np.int64)
    widths = [len(x) for x in sent]
    for k in range(len(cut)):
        a, b, c, d = cells[k], cells[k + 1], pairs[k], pairs[k + 1]
        own_step = mine[0][a:b].copy()
        own_step[1:] -= mine[0][a:b - 1]
        part = [_planes(np.ascontiguousarray(x)) for x in (own_step, *(y[a:b] for y in mine[1:]))]
        raw = b"".join([*(x.tobytes() for x in part), *(x[:, c:d].tobytes() for x in sent)])
        shape = np.array([b - a, d - c, len(raw), plain, coded, len(part), len(sent),
                          *map(len, part), *widths], np.uint32)
        book = values.tobytes() if coded else b""
        yield int(to[a]), int(d - c), b"".join([
            np.uint32([len(shape), len(book)]).tobytes(), shape.tobytes(), book,
            codec.compress(raw, asbytes=True)])


def send(only: str, buckets: int, first: int, centre: bool, chunk: int = CHUNK_PAIRS):
    """``mapInArrow``: rows (left: cells, right: cells or NULL for the same ones, and the
    user's ``total`` and ``number`` if ``centre``) to rows ``SENT``. ``only`` is that of
    ``similarity.summed_pairs``, ``first`` the least item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=ZSTD_LEVEL)
        for batch in batches:
            given = batch.column("right")
            # Rows of one slice have no right side of their own.
            for both in (False, True):
                some = given.is_valid() if both else given.is_null()
                part = batch.filter(some)
                if not part.num_rows:
                    continue
                left = _Cells(part.column("left"), not both)
                right = _Cells(part.column("right"), True) if both else left
                totals = tuple(part.column(x).to_numpy(zero_copy_only=False).astype(np.float64)
                               for x in ("total", "number")) if centre else None
                made = np.diff(left.start) * np.diff(right.start)
                group = np.cumsum(made) // chunk
                bounds = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), part.num_rows]
                for a, b in zip(bounds, bounds[1:]):
                    found = list(_blobs(left.rows(a, b), right.rows(a, b), b - a, only, buckets,
                                        first, totals and tuple(x[a:b] for x in totals), codec))
                    if found:
                        bucket, pairs, blob = zip(*found)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(bucket, pa.int32()), pa.array(pairs, pa.int32()),
                             pa.array(blob, pa.binary())], names=["bucket", "pairs", "blob"])

    return run


def _unpack(blob: pa.Buffer, only: str, first: int, centre: bool, codec: pa.Codec) -> tuple:
    """(cells: i1, size, s, n, q), (pairs: i2, s, n, q) of a blob, centred."""
    count, book = np.frombuffer(blob, np.uint32, 2).tolist()
    shape = np.frombuffer(blob, np.uint32, count, 8).tolist()
    values = np.frombuffer(blob, np.float64, book // 8, 8 + 4 * count)
    n_cells, n_pairs, raw_size, plain, coded, parts, sents = shape[:7]
    widths = shape[7:]
    raw = np.frombuffer(codec.decompress(blob[8 + 4 * count + book:], raw_size), np.uint8)
    columns, at = [], 0
    for k, width in enumerate(widths):
        size = n_cells if k < parts else n_pairs
        planes = raw[at:at + width * size].reshape(width, size)
        at += width * size
        columns.append(planes[0] if coded and k == parts + sents - 1 else _numbers(planes))
    i1 = np.cumsum(columns[0].view(np.int64))
    size = columns[1].view(np.int64)
    s1 = columns[2].view(np.float64)
    own = columns[3:parts]
    step, *rest = columns[parts:]
    s2 = values[rest[0]] if coded else rest[0].view(np.float64)
    if plain:
        n1, q1, n2, q2 = np.ones(n_cells, np.int64), s1 * s1, None, None
    else:
        n1, q1 = own[0].view(np.int64), own[1].view(np.float64)
        n2, q2 = rest[1].view(np.int64), rest[2].view(np.float64)
    head = np.cumsum(size) - size
    run = np.cumsum(step)
    base = i1.view(np.uint64) if only == "half" else np.uint64(first % 2 ** 64)
    i2 = (run + np.repeat(base + step[head] - run[head], size)).view(np.int64)
    if centre:
        mean = own[-2].view(np.float64) / own[-1].view(np.float64)
        means = np.repeat(mean, size)
        q1 = q1 - 2.0 * mean * s1 + n1 * mean * mean
        s1 = s1 - n1 * mean
        if plain:
            q2 = s2 * s2 - 2.0 * means * s2 + means * means
            s2 = s2 - means
        else:
            q2 = q2 - 2.0 * means * s2 + n2 * means * means
            s2 = s2 - n2 * means
    if q2 is None:
        q2 = s2 * s2
    if n2 is None:
        n2 = np.ones(n_pairs, np.int64)
    return (i1, size, s1, n1, q1), (i2, s2, n2, q2)


def _rank_keys(kind: str, damping: float, digits: int, sx, sy, sxy) -> np.ndarray:
    """What ``similarity.top_k`` ranks by: the similarity as a whole number of its last
    place, halves away from zero; NaN before all."""
    with np.errstate(divide="ignore", invalid="ignore"):
        below = np.sqrt(sx) * np.sqrt(sy) + (damping if kind == "pearson" else 0.0)
        sim = np.where(below == 0, 0.0, sxy / below)
        if kind == "pearson":
            sim = np.where(np.abs(sim) < 1e-12, 0.0, sim)
        size = np.abs(sim * float(10 ** digits))
        down = np.trunc(size)
        key = np.copysign(down + (size - down >= .5), sim) + 0.0
    return np.where(np.isnan(key), np.inf, key)


def _best(i1: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Where the ``most`` pairs of largest ``key`` of each i1 are (ascending); of equal
    ones the first. ``i1`` ascends; ``key`` is overwritten."""
    head = np.flatnonzero(np.diff(i1, prepend=-1))
    size = np.diff(np.append(head, len(i1)))
    group = np.repeat(np.arange(len(head)), size)
    taken = np.zeros(len(i1), bool)
    for _ in range(most):
        at = np.flatnonzero(key == np.maximum.reduceat(key, head)[group])
        first = at[np.diff(group[at], prepend=-1) > 0]
        taken[first[key[first] > -np.inf]] = True
        key[first] = -np.inf
    return np.flatnonzero(taken)


def _summed(item: np.ndarray, cells: tuple, pairs: tuple) -> tuple[np.ndarray, ...]:
    """The sums of pairs by (i1, i2), ascending; ``item`` numbers the i1 of each cell."""
    _, size, s1, n1, q1 = cells
    i2, s2, n2, q2 = pairs
    i1 = np.repeat(item, size)
    terms = [np.repeat(q1, size) * n2, np.repeat(n1, size) * q2, np.repeat(s1, size) * s2]
    low, high = int(i2.min()), int(i2.max())
    bits = (high - low).bit_length()
    if bits + int(item.max()).bit_length() <= 63:
        key = (i1 << bits) | (i2 - low)
    else:
        known, code = np.unique(i2, return_inverse=True)
        key = i1 * len(known) + code
    order = np.argsort(key)
    key = key[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    terms = [x[order] for x in terms]
    if len(head) < len(key):
        terms = [np.add.reduceat(x, head) for x in terms]
    return (i1[order[head]], i2[order[head]], *terms, np.diff(np.append(head, len(key))))


def receive(only: str, first: int, centre: bool, best: tuple | None = None,
            piece_pairs: int = SUM_PAIRS):
    """``mapInArrow`` over rows ``SENT``, each partition sorted by bucket, to ``SUMS``.
    ``best`` (kind, damping, digits, k): an item's pairs are its k most similar ones."""
    def bucket_rows(blobs: list) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=ZSTD_LEVEL)
        got = [_unpack(x, only, first, centre, codec) for x in blobs]
        cells = [np.concatenate(x) for x in zip(*(g[0] for g in got))]
        pairs = [np.concatenate(x) for x in zip(*(g[1] for g in got))]
        del got
        order = np.argsort(cells[0], kind="stable")
        size = cells[1]
        at = _ranges((np.cumsum(size) - size)[order], size[order])
        cells, pairs = [x[order] for x in cells], [x[at] for x in pairs]
        known, item = np.unique(cells[0], return_inverse=True)
        size = cells[1]
        load = np.bincount(item, weights=size).astype(np.int64)
        # Pieces of whole items.
        piece = ((np.cumsum(load) - load) // piece_pairs)[item]
        bounds = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(item)]
        ends = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(bounds, bounds[1:]):
            number = item[a:b]
            part = [x[a:b] for x in cells]
            mine = [x[ends[a]:ends[b]] for x in pairs]
            i1, i2, sx, sy, sxy, n = _summed(number, part, mine)
            if best:
                kind, damping, digits, most = best
                key = _rank_keys(kind, damping, digits, sx, sy, sxy)
                some = _best(i1, key, most)
                i1, i2, sx, sy, sxy, n = (x[some] for x in (i1, i2, sx, sy, sxy, n))
            head = np.flatnonzero(np.diff(i1, prepend=-1))
            values = pa.StructArray.from_arrays(
                [pa.array(x) for x in (i2, sx, sy, sxy, n.astype(np.int64))], fields=list(_PAIR))
            lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(i1)).astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([pa.array(known[i1[head]]), lists], names=["i1", "pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
                if bucket != now and held:
                    yield from bucket_rows(held)
                    held = []
                now = bucket
                held.append(pa.py_buffer(blob.as_py()))
        if held:
            yield from bucket_rows(held)

    return run
