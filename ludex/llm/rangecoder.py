"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks that are coded independently: each starts from the
same model and carries a checksum. Within a block the model predicts the
next id twice, from the last two ids (order 2) and from the last one (order 1),
each prediction with a confidence from its past success. The coder codes

    order 2 is right | order 1 is right | neither

with probabilities mixed from two sets of adaptive counters (one by both
confidences, one by the last two outcomes), and in the last case the id itself by
order 0: the class of the id (its bit length) with frequencies that adapt in the
block, then the id in its class.

The model that every block starts from is a ``Start``: the frequencies of ids
(quantised) and the usual follower of each, of all blocks that are kept together.
It is stored once beside them. Without one, ids of a class are equally likely and
nothing is predicted at first.

The range coder is carry-less with a 64-bit state and 32-bit output words. The
blocks of a call go in lockstep, one array element each, so that the coder's
sequential steps are array operations over many blocks.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
# Lanes coded at once (blocks); bounds a worker's memory.
LANES = 4096
ID_BITS = 20

_U, _V = np.uint64, np.uint32
_PROB = 12
_TOTAL = 1 << _PROB
_LOW = _U(1 << 31)
_WORD = _U(1 << 32)
_TABLE_BITS = 10
_SHIFT = _V(32 - _TABLE_BITS)
# Frequencies in a class, out of 2 ** 16; a class of more ids than may share them
# has equally likely ids.
_SHARE_BITS, _MAX_SHARED = 16, 1 << 14
# 1024 * 2 ** (i / 8), the steps of quantised frequencies.
_EIGHTHS = np.array([1024, 1117, 1218, 1328, 1448, 1579, 1722, 1878], np.int64)
# What the classes' frequencies of a start weigh, in 24ths of an id.
_START_WEIGHT = 1200
_K1, _K2 = _V(0x9E3779B1), _V(0x85EBCA77)
# Contexts: both confidences (0 to 3) and whether the predictions agree; the
# last two outcomes.
_CONTEXTS, _PASTS = 32, 16
_CLASSES = ID_BITS + 1
_REFRESH = 32
# Counters hold the probability of the first event in the upper and of the
# second in the lower 16 bits. By outcome: what a step of rate 1/16 takes off
# (the second is not tried when the first happens) and adds.
_OFF = np.array([0x0FFF0000, 0x0FFF0FFF, 0x0FFF0FFF], _V)
_ADD = np.array([4095 << 16, 4095, 0], _V)
_MAGNITUDE = np.zeros(1 << ID_BITS, np.uint8)
for _i in range(ID_BITS):
    _MAGNITUDE[1 << _i: 2 << _i] = _i + 1


class Start:
    """What blocks know before their first id: ``ids`` (rising), ``levels``
    (8 * log2 of their counts), ``followers`` (the usual next id of each) and
    ``trust`` (0 to 3, how often it does follow)."""

    def __init__(self, ids: np.ndarray, levels: np.ndarray, followers: np.ndarray,
                 trust: np.ndarray):
        self.ids, self.levels, self.followers, self.trust = ids, levels, followers, trust
        size = int(ids[-1]) + 1
        classes = _MAGNITUDE[ids]
        weights = _EIGHTHS[levels & 7] << (levels >> 3).astype(np.int64)
        first, share = np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64)
        lower = np.maximum(np.arange(_CLASSES) - 1, 0)
        self.shift = lower.astype(_U)
        self.counts = np.ones(_CLASSES, np.int64)
        self.slots = np.zeros((_CLASSES, 1 << _SHARE_BITS), np.uint16 if size <= 1 << 16 else _V)
        self.shared = np.zeros(_CLASSES, bool)
        self.lowest, self.highest = int(classes.min()), int(classes.max())
        for c in np.unique(classes).tolist():
            a, b = np.searchsorted(classes, [c, c + 1])
            self.counts[c] += int(weights[a:b].sum() * _START_WEIGHT // weights.sum())
            if b - a > _MAX_SHARED:
                first[a:b] = ids[a:b] - (1 << lower[c] if c else 0)
                continue
            spare = (1 << _SHARE_BITS) - (b - a)
            share[a:b] += weights[a:b] * spare // weights[a:b].sum()
            stop = np.cumsum(share[a:b])
            first[a:b] = stop - share[a:b]
            self.slots[c, : stop[-1]] = np.repeat(ids[a:b], share[a:b])
            self.slots[c, stop[-1]:] = ids[b - 1]
            self.shift[c], self.shared[c] = _SHARE_BITS, True
        # A damaged block may name a class without ids and gets id 0.
        self.all_shared = bool(self.shared[np.unique(classes)].all())
        self.first, self.share = np.zeros(size, _U), np.zeros(size, _U)
        self.first[ids], self.share[ids] = first, share
        self.places = (self.first << _U(32)) | self.share
        self.next = np.zeros(size, _V)
        self.next[ids] = (followers << _V(2)) | trust

    @classmethod
    def fit(cls, ids: np.ndarray) -> Start:
        """The start of blocks that hold ``ids`` (one at least)."""
        every = np.bincount(ids)
        known = np.flatnonzero(every)
        counts = every[known]
        levels = np.round(8 * np.log2(counts)).astype(np.uint8)
        followers, trust = np.zeros(len(known), _V), np.zeros(len(known), np.uint8)
        pairs, often = np.unique((ids[:-1].astype(_U) << _U(ID_BITS)) | ids[1:],
                                 return_counts=True)
        if len(pairs):
            before = (pairs >> _U(ID_BITS)).astype(_V)
            # The last of an id's pairs by (count, follower) is the usual one.
            order = np.lexsort((pairs, often, before))
            ends = np.flatnonzero(np.append(before[order][1:] != before[order][:-1], True))
            best = order[ends]
            at = np.searchsorted(known, before[best])
            followers[at] = pairs[best] & _U((1 << ID_BITS) - 1)
            trust[at] = np.minimum(4 * often[best] // counts[at], 3)
        return cls(known.astype(_V), levels, followers, trust)

    @classmethod
    def plain(cls) -> Start:
        """Nothing known: all ids of a class are equally likely."""
        every = np.arange(1 << ID_BITS, dtype=_V)
        out = cls.__new__(cls)
        lower = np.maximum(np.arange(_CLASSES) - 1, 0)
        out.shift, out.counts = lower.astype(_U), np.ones(_CLASSES, np.int64)
        out.first = every - np.where(every > 0, 1 << lower[_MAGNITUDE], 0).astype(_U)
        out.share = np.ones(1 << ID_BITS, _U)
        out.places = (out.first << _U(32)) | out.share
        out.slots, out.shared = np.zeros((_CLASSES, 1), _V), np.zeros(_CLASSES, bool)
        out.next = np.zeros(1, _V)
        out.lowest, out.highest, out.all_shared = 0, _CLASSES - 1, False
        return out

    def shift_of(self, classes: np.ndarray) -> np.ndarray | np.uint64:
        """By how many bits the range is divided among the ids of each class."""
        return _U(_SHARE_BITS) if self.all_shared else self.shift.take(classes)

    def place(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(frequencies below, frequency) of ids in their classes."""
        both = self.places.take(ids)
        return both >> _U(32), both & (_WORD - _U(1))

    def to_bytes(self) -> bytes:
        """By column, compressed; followers as places among the ids."""
        columns = [np.diff(self.ids, prepend=_V(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T,
                   self.levels, self.trust,
                   np.searchsorted(self.ids, self.followers).astype("<u4").view(np.uint8)
                   .reshape(-1, 4).T]
        return zlib.compress(b"".join(c.tobytes() for c in columns), 9)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Start:
        try:
            flat = np.frombuffer(zlib.decompress(raw), np.uint8)
        except zlib.error as damage:
            raise ValueError("the start of a frame is damaged") from damage
        n = len(flat) // 10
        wide = lambda a: np.ascontiguousarray(a.reshape(4, n).T).view("<u4")[:, 0]
        ids = np.cumsum(wide(flat[: 4 * n])).astype(_V)
        places = np.minimum(wide(flat[6 * n:]), n - 1)
        return cls(ids, flat[4 * n: 5 * n], ids[places], flat[5 * n: 6 * n])


_plain: list[Start] = []


def _start(start: Start | None) -> Start:
    if start is None and not _plain:
        _plain.append(Start.plain())
    return start or _plain[0]


class _Model:
    """The models of all lanes; lanes never read each other's state."""

    def __init__(self, lanes: int, start: Start):
        self.start, self.lanes = start, lanes
        self.two = np.zeros(lanes << _TABLE_BITS, _V)
        self.one = np.zeros(lanes << _TABLE_BITS, _V)
        lane = np.arange(lanes, dtype=np.int64)
        self.base = (lane << _TABLE_BITS).astype(_V)
        self.base_x, self.base_y = (lane * _CONTEXTS).astype(_V), lane * _PASTS
        even = _V((1 << 31) + (1 << 15))
        self.confident = np.full(lanes * _CONTEXTS, even, _V)
        self.recent = np.full(lanes * _PASTS, even, _V)
        self.past = np.zeros(lanes, np.int64)
        self.last, self.prior = np.zeros(lanes, _V), np.zeros(lanes, _V)
        # By class, then lane. Classes met since the last refresh are noted by step.
        self.counts = np.repeat(start.counts.astype(np.int32)[:, None], lanes, axis=1)
        self.met = np.full((_REFRESH, lanes), _CLASSES, np.uint8)
        self.steps = 0
        self.refresh(lanes)

    def refresh(self, active: int) -> None:
        """Cumulative frequencies of the classes, out of 4096."""
        counts, met = self.counts[:, :active], self.met[:self.steps, :active]
        for c in range(self.start.lowest, self.start.highest + 1):
            found = np.add.reduce((met == c).view(np.uint8), axis=0, dtype=np.uint8)
            counts[c] += found * np.int32(24)
        self.met[:, :active], self.steps = _CLASSES, 0
        steps = np.zeros((_CLASSES + 1, active), np.int32)
        np.cumsum(counts, axis=0, out=steps[1:])
        total = steps[-1].copy()
        spare = _TOTAL - 2 * _CLASSES
        steps *= np.int32(spare)
        steps //= total
        steps += 2 * np.arange(_CLASSES + 1, dtype=np.int32)[:, None]
        self.active, self.cumulative = active, steps.astype(_V).ravel()
        self.bounds = steps[self.start.lowest + 1: self.start.highest + 1].astype(np.int16)
        aged = np.flatnonzero(total > 8000)
        if len(aged):
            counts[:, aged] = 1 + counts[:, aged] // 2

    def classes(self, lanes: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
        """The class that holds each value, of some of the first ``n`` lanes."""
        every = np.zeros(n, np.int16)
        every[lanes] = values
        over = (self.bounds[:, :n] <= every).view(np.uint8)
        found = np.add.reduce(over, axis=0, dtype=np.uint8)
        return found[lanes].astype(np.int64) + self.start.lowest

    def frequency(self, lanes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(frequencies below, frequency) of a class in each of ``lanes``; it is
        counted at the next refresh."""
        at = classes * self.active
        at += lanes
        first = self.cumulative.take(at)
        at += self.active
        self.met[self.steps, lanes] = classes
        return first.astype(_U), (self.cumulative.take(at) - first).astype(_U)

    def predict(self, n: int) -> tuple[np.ndarray, ...]:
        """(id by order 2, id by order 1, frequency of the first and of both out of
        4096)."""
        mixed = self.last[:n] * _K1
        base = self.base[:n]
        self.at1 = ((mixed >> _SHIFT) + base).astype(np.int64)
        mixed ^= self.prior[:n] * _K2
        self.at2 = ((mixed >> _SHIFT) + base).astype(np.int64)
        e1, e2 = self.one.take(self.at1), self.two.take(self.at2)
        new = np.flatnonzero(e1 == 0)
        e1[new] = self.start.next.take(self.last[new].astype(np.int64), mode="clip")
        trust2 = e2 & _V(3)
        self.trust1 = e1 & _V(3)
        x = (trust2 << _V(2)) + self.trust1
        x += x
        x += ((e1 ^ e2) < _V(4)).view(np.uint8)
        x += self.base_x[:n]
        self.x = x.astype(np.int64)
        self.y = self.base_y[:n] + self.past[:n]
        self.p, self.q = self.confident.take(self.x), self.recent.take(self.y)
        # Both mixes have 17 bits; frequencies stay off 0 and 4096.
        f2 = ((((self.p >> _V(16)) + (self.q >> _V(16))) * _V(3968)) >> _V(17)) + _V(32)
        f1 = (((self.p & _V(0xFFFF)) + (self.q & _V(0xFFFF)) >> _V(2)) * (_V(4064) - f2)
              >> _V(15)) + _V(8)
        self.e1, self.e2, self.trust2 = e1, e2, trust2
        return e2 >> _V(2), e1 >> _V(2), f2.astype(_U), (f2 + f1).astype(_U)

    def update(self, n: int, ids: np.ndarray, outcome: np.ndarray, right2: np.ndarray,
               right1: np.ndarray) -> None:
        """``outcome``: 0, 1, 2 as coded; ``right``: whether an order was."""
        off, add = _OFF.take(outcome), _ADD.take(outcome)
        for counters, at, held in ((self.confident, self.x, self.p),
                                   (self.recent, self.y, self.q)):
            step = held >> _V(4)
            step &= off
            held -= step
            held += add
            counters[at] = held
        fresh = ids << _V(2)
        e1, e2 = self.e1, self.e2
        e2 += (self.trust2 != _V(3)).view(np.uint8)
        self.two[self.at2] = np.where(right2, e2, fresh)
        # A trusted follower survives a miss.
        trust1 = self.trust1
        kept = np.where(trust1 > _V(1), e1 - _V(1), fresh)
        e1 += (trust1 != _V(3)).view(np.uint8)
        self.one[self.at1] = np.where(right1, e1, kept)
        past = self.past[:n]
        past <<= 2
        past &= 15
        past |= outcome
        self.prior[:n] = self.last[:n]
        self.last[:n] = ids
        self.steps += 1


class _Range:
    """low and range of each lane; subclasses move words out or in."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, _U)
        self.range = np.full(lanes, (1 << 64) - 1, _U)

    def settle(self, low: np.ndarray, wide: np.ndarray, lanes: np.ndarray | None) -> None:
        """Move the upper words that are settled; ``lanes``: whose low and
        range these are, if not the first ones."""
        at = np.flatnonzero(wide < _WORD)  # no other range leaves a word settled
        if not len(at):
            return
        settled, part = low[at], wide[at]
        same = (settled ^ (settled + part)) < _WORD
        tight = part < _LOW
        part = np.where(same, part, (_U(0) - settled) & (_LOW - _U(1)))
        same |= tight
        go = np.flatnonzero(same)
        at, settled = at[go], settled[go]
        self.move(at if lanes is None else lanes[at], settled)
        low[at] = settled << _U(32)
        wide[at] = part[go] << _U(32)


class _Encoder(_Range):
    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes)
        self.size = 2 * steps + 4
        self.words = np.empty(lanes * self.size, _V)
        self.place = np.arange(lanes) * self.size

    def move(self, at: np.ndarray, low: np.ndarray) -> None:
        place = self.place[at]
        self.words[place] = low >> _U(32)
        place += 1
        self.place[at] = place

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(2):
            self.move(every, self.low)
            self.low <<= _U(32)
        return [self.words[i * self.size: k].astype("<u4").tobytes()
                for i, k in enumerate(self.place.tolist())]


class _Decoder(_Range):
    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads))
        size = max(len(p) for p in payloads) // 4 + 4
        words = np.zeros((len(payloads), size), _V)
        for i, p in enumerate(payloads):
            words[i, : len(p) // 4] = np.frombuffer(p[: len(p) // 4 * 4], "<u4")
        self.code = (words[:, 0].astype(_U) << _U(32)) | words[:, 1]
        self.words, self.place = words.ravel(), np.arange(len(payloads)) * size + 2

    def move(self, at: np.ndarray, low: np.ndarray) -> None:
        # A damaged block may ask for more words than it has: it reads others,
        # and its checksum tells.
        place = self.place[at]
        self.code[at] = (self.code[at] << _U(32)) | self.words.take(place, mode="clip")
        place += 1
        self.place[at] = place


def _active(lengths: np.ndarray) -> list[int]:
    """How many lanes (by falling length) are still running at each step."""
    steps = int(lengths[0])
    return (len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps),
                                           side="right")).tolist()


def _outcome(first: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """0 where order 2 was right, 1 where order 1 was, 2 elsewhere."""
    return (np.uint8(2) - hit.view(np.uint8) - first.view(np.uint8)).astype(np.int64)


def _encode_lanes(blocks: list[np.ndarray], start: Start) -> list[bytes]:
    """``blocks`` by falling length."""
    lengths = np.array([len(b) for b in blocks])
    rows = np.zeros((len(blocks), int(lengths[0])), _V)
    for row, block in zip(rows, blocks, strict=True):
        row[: len(block)] = block
    grid = np.ascontiguousarray(rows.T)
    model, coder = _Model(len(blocks), start), _Encoder(len(blocks), len(grid))
    none = np.zeros(len(blocks), _U)
    for t, n in enumerate(_active(lengths)):
        ids = grid[t, :n]
        if t and t % _REFRESH == 0:
            model.refresh(n)
        id2, id1, f2, both = model.predict(n)
        right2, right1 = ids == id2, ids == id1
        hit = right2 | right1
        outcome = _outcome(right2, hit)
        low, wide = coder.low[:n], coder.range[:n]
        part = wide >> _U(_PROB)
        f2 *= part
        both *= part
        part <<= _U(_PROB)
        low += np.where(right2, none[:n], np.where(hit, f2, both))
        part -= both
        both -= f2
        wide[:] = np.where(right2, f2, np.where(hit, both, part))
        coder.settle(low, wide, None)
        miss = np.flatnonzero(~hit)
        if len(miss):
            new = ids[miss].astype(np.int64)
            magnitude = _MAGNITUDE[new].astype(np.int64)
            first, size = model.frequency(miss, magnitude)
            low, part = low[miss], wide[miss]
            part >>= _U(_PROB)
            first *= part
            low += first
            part *= size
            part >>= start.shift_of(magnitude)
            first, share = start.place(new)
            first *= part
            low += first
            part *= share
            coder.settle(low, part, miss)
            coder.low[miss], coder.range[miss] = low, part
        model.update(n, ids, outcome, right2, right1)
    return coder.finish()


def _decode_lanes(payloads: list[bytes], lengths: np.ndarray, start: Start) -> list[np.ndarray]:
    grid = np.zeros((int(lengths[0]), len(payloads)), _V)
    model, coder = _Model(len(payloads), start), _Decoder(payloads)
    none = np.zeros(len(payloads), _U)
    for t, n in enumerate(_active(lengths)):
        if t and t % _REFRESH == 0:
            model.refresh(n)
        id2, id1, f2, both = model.predict(n)
        low, wide = coder.low[:n], coder.range[:n]
        part = wide >> _U(_PROB)
        offset = coder.code[:n] - low
        f2 *= part
        both *= part
        part <<= _U(_PROB)
        coded2, hit = offset < f2, offset < both
        low += np.where(coded2, none[:n], np.where(hit, f2, both))
        part -= both
        both -= f2
        wide[:] = np.where(coded2, f2, np.where(hit, both, part))
        coder.settle(low, wide, None)
        outcome = _outcome(coded2, hit)
        ids = np.where(coded2, id2, id1)
        miss = np.flatnonzero(~hit)
        if len(miss):
            low, part, code = low[miss], wide[miss], coder.code[miss]
            part >>= _U(_PROB)
            value = np.minimum((code - low) // part, _U(_TOTAL - 1))
            magnitude = model.classes(miss, n, value)
            first, size = model.frequency(miss, magnitude)
            first *= part
            low += first
            part *= size
            shift = start.shift_of(magnitude)
            part >>= shift
            place = np.minimum((code - low) // np.maximum(part, _U(1)),
                               (_U(1) << shift) - _U(1)).astype(np.int64)
            if start.all_shared:
                known = new = start.slots.take((magnitude << _SHARE_BITS) + place)
            else:
                new = np.where(start.shared.take(magnitude),
                               start.slots[magnitude, np.minimum(place, start.slots.shape[1] - 1)],
                               np.where(magnitude > 0, (1 << shift.astype(np.int64)) + place, 0))
                known = np.minimum(new, len(start.places) - 1)
            known = known.astype(np.int64)
            first, share = start.place(known)
            first *= part
            low += first
            part *= share
            part = np.maximum(part, _U(1))  # only in a damaged block
            coder.settle(low, part, miss)
            coder.low[miss], coder.range[miss] = low, part
            ids[miss] = new
        grid[t, :n] = ids
        model.update(n, ids, outcome, ids == id2, ids == id1)
    rows = np.ascontiguousarray(grid.T)
    return [rows[i, :k] for i, k in enumerate(lengths.tolist())]


def encode_blocks(blocks: list[np.ndarray], start: Start | None = None) -> list[bytes]:
    """Code each block (a non-empty array of ids below 2 ** 20) on its own, all
    from ``start``, which has to know all their ids."""
    start = _start(start)
    for block in blocks:
        if not len(block) or int(block.max()) >= 1 << ID_BITS:
            raise ValueError("a block needs ids below 2 ** 20, at least one")
        if int(block.max()) >= len(start.share) or not start.share.take(block).all():
            raise ValueError("a block holds an id that the start does not know")
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    out: list[bytes] = [b""] * len(blocks)
    for at in range(0, len(order), LANES):
        lanes = order[at: at + LANES]
        for i, payload in zip(lanes, _encode_lanes([blocks[i] for i in lanes], start), strict=True):
            out[i] = payload
    return out


def decode_blocks(payloads: list[bytes], lengths: list[int],
                  checksums: list[int], start: Start | None = None) -> list[np.ndarray]:
    """The ids of each block, coded from ``start``; a block whose ids do not have
    its checksum raises ValueError."""
    start = _start(start)
    order = sorted(range(len(payloads)), key=lambda i: -lengths[i])
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(payloads)
    for at in range(0, len(order), LANES):
        lanes = order[at: at + LANES]
        with np.errstate(over="ignore"):
            found = _decode_lanes([payloads[i] for i in lanes],
                                  np.array([lengths[i] for i in lanes]), start)
        for i, ids in zip(lanes, found, strict=True):
            if checksum(ids) != checksums[i]:
                raise ValueError(f"block {i} is damaged")
            out[i] = ids
    return out


def checksum(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
