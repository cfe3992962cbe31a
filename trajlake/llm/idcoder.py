"""An adaptive context-mixing range coder for token ids: many blocks at once, each reset to the same start and with its own checksum.

A table goes with a set of blocks (a file's): the distinct ids by falling frequency, and their counts. An id's place in it is its rank; the rarest
beyond ``DENSE`` share one rank and are told apart by their counts. Each block predicts its next rank from what it has learnt by itself:

* order 0 counts each rank, from a start in proportion to the table;
* order 1 keeps, for each rank, which rank leads among those that came after it, and by how much it leads (0 to 3);
* order 2 keeps the same for each pair of ranks, in slots that hold the pair, so another pair in the slot is no prediction.

How often a lead of each size has held is counted by block, orders 1 and 2 apart, and these shares are the weights that mix the three into one
distribution for each id: w2 on order 2's leader, w1 on order 1's, and the rest over all ranks by order 0's counts. A range coder codes the id's
interval. Every id is learnt: leaders at once, counts and shares after every ``STEP`` ids by all of them. Blocks share no state but the
table, so NumPy works on up to ``LANES`` blocks in step (``READ_LANES`` when decoding), and any block can be decoded alone. How many doesn't show in the code.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

#: Ids in a block, and between two updates of its counts; most ids in a block, so that sums of counts stay below 2^16.
BLOCK, STEP, MOST = 2048, 32, 4096
#: Most blocks that are encoded side by side, of up to 25 KB of state each, and decoded, when a worker holds no texts: 31 and 45 MB, however large the file.
#: The more there are, the less a NumPy call costs for each.
LANES, READ_LANES = 1280, 1792
#: Ids that NumPy widens to 64 bits at once.
_WIDENED = 1 << 19
#: Ranks of a group, which a row of 32 sums stands for; most ranks of their own.
GROUP = 31
DENSE = 4000
#: What an id adds to its count; how many ids the start of the counts stands for.
GAIN, PRIOR = 8, 800
#: Bits of the mixed distribution's total; of the low end; below which range words of 16 bits go out.
_TOTAL, _LOW, _LEAST = 26, 48, 32
_MASK = (1 << _LOW) - 1
#: Slots of order 2, and an odd factor that scrambles pairs of ranks one to one.
_SLOT_BITS, _ODD = 11, 0x9E3779
_SLOTS, _CHECK_BITS = 1 << _SLOT_BITS, 24 - _SLOT_BITS
#: Where the shares of leads 1 to 3 that hold start: hits of 32 tries, for orders 1 and 2; the largest share, as 1 / (1 - share).
_START1, _START2, _TRIES = np.array([0, 2, 10, 26]), np.array([0, 3, 20, 30]), np.array([1, 32, 32, 32])
_MOST1, _MOST2 = 16, 64
#: Groups that are looked through at once when decoding, and a number that no sum of counts is.
_PART, _NEVER = 16, (1 << 16) - 1
#: Numbers as arrays: on a few thousand blocks a NumPy call takes half as long again if it must convert a Python number.
_U1, _U2, _U3, _U4 = (np.array(i, np.uint16) for i in (1, 2, 3, 4))
_PAIR, _SCRAMBLE, _BITS, _CHECK, _SHIFT, _WIDE, _MATCH = (np.array(i, np.uint32) for i in (12, _ODD, 0xFFFFFF, (1 << _CHECK_BITS) - 1, _CHECK_BITS, 14, 1 << 14))
_TOTAL_, _LEAST_, _FULL, _MASK_, _16 = (np.array(i) for i in (_TOTAL, _LEAST, 1 << _LEAST, _MASK, 16))
_NONE, _ONE, _MOST_V = (np.array(i) for i in (0, 1, (1 << _TOTAL) - 1))
_BYTES, _TOP, _PART_ = np.array(0x0101010101010101, np.uint64), np.array(56, np.uint64), np.array(_PART)
_TWO, _HALF, _LOWER = (np.array(i) for i in (2, 32, (1 << 32) - 1))
_BYTE16, _GAIN = np.array(16, np.uint8), np.array(GAIN, np.uint16)
#: Bytes of a cache line, and numbers by which rows of a power of two are longer, or all would lie in the same few cache lines.
_LINE, _PAD = 64, 16


@dataclass
class Table:
    """The distinct ids in order of falling count (ties by id) and their counts."""

    ids: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        self.own = min(len(self.ids), DENSE - 1)
        self.rare = np.concatenate(([0], np.cumsum(self.counts[self.own :], dtype=np.int64)))
        ranks = self.own + (self.own < len(self.ids))
        self.groups = max(1, -(-ranks // GROUP))
        share = np.zeros(self.groups * GROUP)
        share[: self.own] = self.counts[: self.own]
        if ranks > self.own:
            share[self.own] = self.rare[-1]
        start = np.maximum(np.rint(share * (PRIOR * GAIN / max(1, int(share.sum())))), 1).astype(np.int64).reshape(self.groups, GROUP)
        self.start = np.concatenate((np.zeros((self.groups, 1), np.int64), np.cumsum(start, 1)), 1).astype(np.uint16)
        self.total = int(start.sum())
        self._back: np.ndarray | None = None

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        if len(ids) and int(ids.max()) < 1 << 20:
            counts = np.zeros(int(ids.max()) + 1, np.int64)
            for at in range(0, len(ids), _WIDENED):
                counts += np.bincount(ids[at : at + _WIDENED], minlength=len(counts))
            own = np.flatnonzero(counts)
            counts = counts[own]
        else:
            own, counts = np.unique(ids, return_counts=True)
        order = np.lexsort((own, -counts))
        return cls(own[order].astype(np.int64), counts[order].astype(np.int64))

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The place of each id in the table."""
        if len(self.ids) and int(self.ids.max()) < 1 << 20:
            if self._back is None:
                self._back = np.zeros(int(self.ids.max()) + 1, np.int32)
                self._back[self.ids] = np.arange(len(self.ids))
            return self._back[ids]
        order = np.argsort(self.ids)
        return order[np.searchsorted(self.ids[order], ids)].astype(np.int32)

    def to_bytes(self) -> bytes:
        order = np.argsort(self.ids)
        steps = np.diff(self.ids[order], prepend=0)
        return zlib.compress(np.concatenate(([len(order)], steps, self.counts[order])).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 9)

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        flat = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)
        ids, counts = np.cumsum(flat[1 : 1 + flat[0]]), flat[1 + flat[0] :]
        order = np.lexsort((ids, -counts))
        return cls(ids[order], counts[order])


#: Row s: what a rank at place s of its group adds to the group's sums.
_ADD = ((np.arange(GROUP + 1) > np.arange(GROUP)[:, None]) * GAIN).astype(np.uint16)


def _quotient(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a // b of whole numbers below 2^48: a float64 quotient of such never rounds up to a whole number that it is below."""
    return (a / b).astype(np.int64)


def _led(v: np.ndarray, lead: np.ndarray, same: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Leaders and leads ``v`` after ranks came that would lead by 1 as ``new``; their leads, and where the leaders came."""
    to = np.minimum(lead, _U2)
    to *= same
    to += new
    np.putmask(to, (lead > _U1) > same, v - _U1)
    return to


def _lines(rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` copies of some rows, from the begin of a cache line on: a row is one line then, not parts of two."""
    raw = np.empty(n * rows.nbytes + _LINE, np.uint8)
    at = -raw.ctypes.data % _LINE
    out = raw[at : at + n * rows.nbytes].view(rows.dtype).reshape(n, *rows.shape)
    out[:] = rows
    return out.reshape(-1, rows.shape[-1])


def _rows(x: np.ndarray) -> np.ndarray:
    """How many of fewer than 256 rows are true, for each column."""
    return np.add.reduce(x.view(np.uint8), 0, dtype=np.uint8)


class _Model:
    """What ``n`` blocks have learnt."""

    def __init__(self, table: Table, n: int) -> None:
        self.table, self.groups = table, table.groups
        self.ranks = self.groups * GROUP
        self.sums = _lines(table.start, n)
        self.lines = self.sums.view(f"V{2 * GROUP + 2}")[:, 0]
        self.before = np.tile(np.concatenate(([0], np.cumsum(table.start[:, GROUP]))).astype(np.uint16)[:, None], n)
        self.total = table.total
        self.t1 = np.zeros(n * self.ranks, np.uint16)
        self.t2 = np.zeros(n * _SLOTS, np.uint32)
        self.hits1, self.hits2, self.tries1, self.tries2 = (np.tile(x, (n, 1)) for x in (_START1, _START2, _TRIES, _TRIES))
        self.shrink(n)

    def shrink(self, n: int) -> None:
        """From now on the first ``n`` blocks alone."""
        self.n = n
        self.lane = np.arange(n)
        self.lane1, self.lane4, self.row = (self.lane * w for w in (self.ranks, 4, self.groups))
        self.lane2 = (self.lane * _SLOTS).astype(np.uint32)
        self.before = np.ascontiguousarray(self.before[:, :n])
        self.old, self.add = np.empty((2, n, GROUP + 1), np.uint16)
        self.refresh()

    def refresh(self) -> None:
        """Weights, from counts: for each block and leads of orders 2 and 1, where their intervals end and what one of order 0's counts is worth.

        The last two are one number, or they'd take more of a cache than there is.
        """
        n = self.n
        share2 = np.minimum(_quotient(self.hits2[:n] << _TOTAL, self.tries2[:n]), (1 << _TOTAL) - (1 << _TOTAL) // _MOST2)
        share1 = np.minimum(_quotient(self.hits1[:n] << 16, self.tries1[:n]), (1 << 16) - (1 << 16) // _MOST1)
        mixed = ((1 << _TOTAL) - share2)[:, :, None] * share1[:, None]
        mixed >>= 16
        mixed += share2[:, :, None]
        unit = _quotient(((1 << _TOTAL) - mixed) << 16, self.total)  # less than 2^31, as totals are more than 2^11
        mixed <<= _HALF
        mixed |= unit
        self.end2, self.mixed = share2.reshape(-1), mixed.reshape(-1)

    def pair(self, x2: np.ndarray, x1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """24 bits of a pair of ranks (32-bit numbers): a slot of order 2 and, above 14 bits, what tells the pair from others in it."""
        pair = x2 << _PAIR
        pair |= x1
        pair *= _SCRAMBLE
        pair &= _BITS
        check = pair & _CHECK
        check <<= _WIDE
        pair >>= _SHIFT
        pair += self.lane2
        return pair.astype(np.int64), check

    def leaders(self, i1: np.ndarray, i2: np.ndarray, check: np.ndarray, v: np.ndarray) -> None:
        """Leaders and leads of orders 1 and 2 into ``v``, 0 where the slot holds another pair."""
        self.t1.take(i1, out=v[0], mode="clip")
        wide = self.t2.take(i2, mode="clip")
        wide ^= check
        np.multiply(wide.astype(np.uint16), wide < _MATCH, out=v[1])

    def weights(self, v: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, ...]:
        """Lead 2, lead 1, end of order 2's interval, end of order 1's, order 0's unit, from leaders and leads of orders 1 and 2."""
        c1, c2 = lead[0].astype(np.uint8), lead[1].astype(np.uint8)
        # Where both orders lead to one rank, order 1 has nothing to add.
        c1 *= ((v[0] ^ v[1]) > _U3) >= c2.astype(bool)
        at = self.lane4 + c2
        end2 = self.end2.take(at, mode="clip")
        at <<= _TWO
        at += c1
        unit = self.mixed.take(at, mode="clip")
        end1 = unit >> _HALF
        unit &= _LOWER
        return c2, c1, end2, end1, unit

    def lead(self, new: np.ndarray, i1: np.ndarray, i2: np.ndarray, check: np.ndarray, v: np.ndarray, lead: np.ndarray, same: np.ndarray) -> None:
        """Learns who leads: a leader that has come again gains, another that came makes it lose, and takes its place at a lead of 1."""
        to = _led(v, lead, same, new)
        self.t1[i1] = to[0]
        self.t2[i2] = check | to[1]

    def count(self, x: np.ndarray, c2: np.ndarray, hit2: np.ndarray, c1: np.ndarray, hit1: np.ndarray) -> None:
        """Learns a step's ids (one row for each of STEP) and which leads have held."""
        group = x // GROUP
        place = (x - group * GROUP).astype(np.int64)
        new = self.old.view(self.lines.dtype)[:, 0]
        more = np.zeros(self.groups * self.n, np.uint16)
        for g, s, at in zip(group + self.row, place, group * self.n + self.lane, strict=True):
            self.sums.take(g, 0, out=self.old, mode="clip")
            _ADD.take(s, 0, out=self.add, mode="clip")
            self.old += self.add
            self.lines[g] = new
            own = more.take(at, mode="clip")
            own += _GAIN
            more[at] = own
        run = np.zeros(self.n, np.uint16)
        for m, b in zip(more.reshape(self.groups, self.n), self.before[1:], strict=True):
            run += m
            b += run
        missed = ~hit2  # only then order 1 is asked
        for k in range(1, len(_TRIES)):  # a lead of 0 predicts nothing
            for lead, asked, hit, tries, hits in ((c2, None, hit2, self.tries2, self.hits2), (c1, missed, hit1, self.tries1, self.hits1)):
                own = lead == k
                if asked is not None:
                    own &= asked
                tries[: self.n, k] += _rows(own)
                own &= hit
                hits[: self.n, k] += _rows(own)
        self.total += GAIN * len(x)
        self.refresh()


class _Writer:
    def __init__(self, n: int, words: int) -> None:
        self.low, self.range = np.zeros(n, np.int64), np.full(n, 1 << _LOW)
        self.out, self.begin = np.zeros((n, words), np.int32), np.arange(n) * words
        self.at = self.begin.copy()

    def room(self, words: int) -> None:
        """Makes sure that each block has place for so many more words."""
        most = int((self.at - self.begin).max()) + words
        if most > self.out.shape[1]:
            self.out = np.concatenate((self.out, np.zeros((len(self.out), max(128, most - self.out.shape[1])), np.int32)), 1)
            self.at -= self.begin
            self.begin = np.arange(len(self.out)) * self.out.shape[1]
            self.at += self.begin
        self.flat = self.out.reshape(-1)

    def code(self, start: np.ndarray, width: np.ndarray, r: np.ndarray, k: np.ndarray | slice) -> None:
        """Codes [start, start + width) in units of ``r`` on the blocks k, which are different ones: two words each at most."""
        low, at, range_ = self.low[k], self.at[k], width * r  # of a slice, low and at are views
        low += start * r
        over = (low > _MASK_).nonzero()[0]
        if over.size:  # words may pass 16 bits; carries run left at the end
            self.flat[at[over] - 1] += 1
            low &= _MASK_
        # All blocks write the word that would go out next; where none goes out, it will be written over.
        small = range_ < _FULL
        self.flat[at] = low >> _LEAST_
        at += small
        shift = small.view(np.uint8) * _BYTE16
        low <<= shift
        low &= _MASK_
        range_ <<= shift
        few = (range_ < _FULL).nonzero()[0]
        while few.size:  # a second word, of a few blocks
            own = low[few]
            self.flat[at[few]] = own >> _LEAST_
            at[few] += 1
            low[few] = own << _16 & _MASK_
            own = range_[few] << _16
            range_[few] = own
            few = few[own < _FULL]
        self.range[k] = range_
        if not isinstance(k, slice):
            self.low[k], self.at[k] = low, at

    def close(self) -> list[bytes]:
        self.room(_LOW // 16 + 1)
        for shift in range(_LOW - 16, -1, -16):
            self.flat[self.at] = self.low >> shift & 0xFFFF
            self.at += 1
        self.flat[self.at] = 0
        out = self.out
        over = out >> 16
        while over.any():
            out &= 0xFFFF
            out[:, :-1] += over[:, 1:]
            over = out >> 16
        return [row[:n].astype("<u2").tobytes() for row, n in zip(out, (self.at - self.begin).tolist(), strict=True)]


class _Reader:
    def __init__(self, blocks: list[bytes]) -> None:
        n = len(blocks)
        words = [np.frombuffer(b, "<u2") for b in blocks]
        self.width = max(map(len, words)) + 4
        self.words = np.zeros((n, self.width), "<u2")
        for row, w in zip(self.words, words, strict=True):
            row[: len(w)] = w
        self.words = self.words.reshape(-1)
        self.at = np.arange(n) * self.width
        self.range, self.value = np.full(n, 1 << _LOW), np.zeros(n, np.int64)
        for _ in range(_LOW // 16):
            self.value = self.value << 16 | self.words[self.at]
            self.at += 1

    def take(self, start: np.ndarray, width: np.ndarray, r: np.ndarray, k: np.ndarray | slice) -> None:
        value, at, range_ = self.value[k], self.at[k], width * r  # of a slice, value and at are views
        value -= start * r
        small = range_ < _FULL
        shift = small.view(np.uint8) * _BYTE16
        value <<= shift
        value |= self.words.take(at, mode="clip") * small
        range_ <<= shift
        at += small
        few = (range_ < _FULL).nonzero()[0]
        while few.size:  # a second word, of a few blocks
            value[few] = value[few] << _16 | self.words.take(at[few], mode="clip")
            at[few] += 1
            own = range_[few] << _16
            range_[few] = own
            few = few[own < _FULL]
        self.range[k] = range_
        if not isinstance(k, slice):
            self.value[k], self.at[k] = value, at


def _padded(n: int) -> int:
    return -(-n // STEP) * STEP


def encode(ids: np.ndarray, table: Table | None = None, block: int = BLOCK) -> list[tuple[int, int, bytes]]:
    """Blocks of (ids, CRC-32 of the ids as little-endian 32-bit values and then the code, code), in order; none for no ids.

    The table (that of all the ids, if none is given) must have every id. A block is at most ``MOST`` ids.
    """
    ids = np.ascontiguousarray(ids, "<u4")
    if not 0 < block <= MOST:
        raise ValueError(f"a block has 1 to {MOST} ids")
    table = table or Table.of(ids)
    n = -(-len(ids) // block)
    blocks = []
    for part in np.array_split(np.arange(n), -(-n // LANES)) if n else []:
        blocks += _encode(ids[part[0] * block : (part[-1] + 1) * block], table, block)
    return blocks


def _encode(ids: np.ndarray, table: Table, block: int) -> list[tuple[int, int, bytes]]:
    """Blocks side by side."""
    n = -(-len(ids) // block)
    full = _padded(block)
    last = _padded(len(ids) - (n - 1) * block)
    steps = np.zeros((n, full + _PAD), np.int32)
    whole = (n - 1) * block
    some = max(1, _WIDENED // block)
    for b in range(0, n - 1, some):
        own = ids[b * block : min(b + some, n - 1) * block]
        steps[b : min(b + some, n - 1), :block] = table.places(own).reshape(-1, block)
    steps[-1, : len(ids) - whole] = table.places(ids[whole:])
    model, out = _Model(table, n), _Writer(n, block // 2 + 64)
    x1, x2 = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    k = slice(0, n)
    for t in range(0, full if n > 1 else last, STEP):
        if t == last and n > 1:
            model.shrink(n - 1)
            k, x1, x2 = slice(0, n - 1), x1[:-1], x2[:-1]
        out.room(4 * STEP)
        place = np.ascontiguousarray(steps[k, t : t + STEP].T)
        x = np.minimum(place, table.own).astype(np.uint32)
        past1 = np.concatenate((x1[None], x[:-1]))
        past2 = np.concatenate((x2[None], past1[:-1]))
        i1 = model.lane1 + past1
        i2, check = model.pair(past2, past1)
        new = x.astype(np.uint16)
        new <<= _U2
        new += _U1
        v, lead = np.empty((2, STEP, 2, model.n), np.uint16)
        same = np.empty(v.shape, bool)
        for j in range(STEP):
            model.leaders(i1[j], i2[j], check[j], v[j])
            np.bitwise_and(v[j], _U3, out=lead[j])
            np.less(v[j] ^ new[j], _U4, out=same[j])
            model.lead(new[j], i1[j], i2[j], check[j], v[j], lead[j], same[j])
        c2, c1, b2, b1, unit = model.weights(v.swapaxes(0, 1), lead.swapaxes(0, 1))
        hit2 = same[:, 1] & (c2 > 0)
        hit1 = same[:, 0] & (c1 > 0) & ~hit2
        group = x // GROUP
        at = model.row * (GROUP + 1) + (x + group)  # a row has one number more than ranks
        flat = model.sums.reshape(-1)
        before = model.before.reshape(-1).take(group * model.n + model.lane, mode="clip")
        start = (before + flat.take(at, mode="clip")) * unit
        start >>= _16
        start += b1
        at += 1
        end = (before + flat.take(at, mode="clip")) * unit
        end >>= _16
        end += b1
        np.putmask(start, hit1, b2)
        start *= ~hit2
        np.putmask(end, hit1, b1)
        np.putmask(end, hit2, b2)
        end -= start
        rare = x == DENSE - 1 if len(table.rare) > 1 else None
        for j in range(STEP):
            out.code(start[j], end[j], out.range[k] >> _TOTAL_, k)
            if rare is not None and rare[j].any():
                own = np.flatnonzero(rare[j])
                p = place[j, own] - table.own
                out.code(table.rare[p], table.rare[p + 1] - table.rare[p], out.range[own] // table.rare[-1], own)
        model.count(x, c2, hit2, c1, hit1)
        x1, x2 = x[-1], x[-2]
    blocks = []
    for b, code in enumerate(out.close()):
        own = ids[b * block : (b + 1) * block]
        blocks.append((len(own), zlib.crc32(code, zlib.crc32(own.tobytes())), code))
    return blocks


def decode(blocks: list[tuple[int, int, bytes]], table: Table) -> list[np.ndarray]:
    """The ids of each block; ValueError if a checksum doesn't hold."""
    return np.split(decode_row(blocks, table), np.cumsum([n for n, _, _ in blocks])[:-1]) if blocks else []


def decode_row(blocks: list[tuple[int, int, bytes]], table: Table) -> np.ndarray:
    """The ids of all blocks in a row, of which there is one copy alone; ValueError if a checksum doesn't hold."""
    order = sorted(range(len(blocks)), key=lambda b: -blocks[b][0])
    ends = np.cumsum([n for n, _, _ in blocks], dtype=np.int64)
    out = np.empty(int(ends[-1]) if blocks else 0, "<u4")
    values = table.ids.astype("<u4")
    for part in np.array_split(np.arange(len(blocks)), -(-len(blocks) // READ_LANES)) if blocks else []:
        own = order[part[0] : part[-1] + 1]
        for b, places in zip(own, _decode([blocks[b] for b in own], table), strict=True):
            ids = values.take(places[: blocks[b][0]], out=out[ends[b] - blocks[b][0] : ends[b]], mode="clip")
            if zlib.crc32(blocks[b][2], zlib.crc32(ids)) != blocks[b][1]:
                raise ValueError(f"the checksum of block {b} doesn't hold")
    return out


def _decode(blocks: list[tuple[int, int, bytes]], table: Table) -> np.ndarray:
    """A row of places in the table for each of some blocks side by side, none longer than the one before."""
    sizes = np.array([_padded(n) for n, _, _ in blocks])
    model, source = _Model(table, len(blocks)), _Reader([code for _, _, code in blocks])
    got = np.zeros((len(blocks), int(sizes[0]) + _PAD), np.int32)
    x1, x2 = np.zeros(len(blocks), np.uint32), np.zeros(len(blocks), np.uint32)
    live = 0
    for t in range(0, int(sizes[0]), STEP):
        now = int(np.searchsorted(-sizes, -t, "left"))  # blocks with more than t ids
        if now != live:
            live = now
            model.shrink(live)
            x1, x2 = x1[:live], x2[:live]
            lane32 = np.arange(live) * (GROUP + 1)
            rows, below = np.empty((live, GROUP + 1), np.uint16), np.empty((live, GROUP + 1), bool)
            words = below.view(np.uint64)
            # Where groups begin, a row for each block; the first of each _PART of them is looked for before the others of its part.
            parts = -(-model.groups // _PART)
            begins = np.full((live, parts * _PART), _NEVER, np.uint16)
            part, inside = np.empty((live, _PART), np.uint16), np.empty((live, _PART), bool)
            lane_parts, lane_part, halves = np.arange(live) * parts, np.arange(live) * _PART, inside.view(np.uint64)
        k = slice(0, live)
        shape = (STEP, live)
        x, c2, c1 = np.empty(shape, np.uint32), np.empty(shape, np.uint8), np.empty(shape, np.uint8)
        hit2, hit1, place = np.empty(shape, bool), np.empty(shape, bool), np.empty(shape, np.int32)
        begins[:, : model.groups] = model.before[: model.groups].T
        leaders = np.empty((2, live), np.uint16)
        flat, firsts, by_part = rows.reshape(-1), model.before[_PART : model.groups : _PART], begins.reshape(-1, _PART)
        for j in range(STEP):
            i1 = model.lane1 + x1
            i2, check = model.pair(x2, x1)
            model.leaders(i1, i2, check, leaders)
            lead = leaders & _U3
            c2[j], c1[j], b2, b1, unit = model.weights(leaders, lead)
            r = source.range[k] >> _TOTAL_
            v = np.minimum(_quotient(source.value[k], r), _MOST_V)
            is2 = np.less(v, b2, out=hit2[j])
            is1 = np.greater(v < b1, is2, out=hit1[j])
            v -= b1
            np.maximum(v, _NONE, out=v)
            v += _ONE
            v <<= _16
            v -= _ONE
            c = np.minimum(_quotient(v, unit), model.total - 1).astype(np.uint16)
            group = _rows(firsts <= c).astype(np.int64)
            by_part.take(lane_parts + group, 0, out=part, mode="clip")
            np.less_equal(part, c[:, None], out=inside)
            # How many of a row: the sum of its bytes, which is at most _PART, and GROUP + 1 below.
            s = halves[:, 0] + halves[:, 1]
            s *= _BYTES
            s >>= _TOP
            s = s.view(np.int64)
            s -= _ONE
            before = part.reshape(-1).take(lane_part + s, mode="clip")
            group *= _PART_
            group += s
            model.sums.take(model.row + group, 0, out=rows, mode="clip")
            np.less_equal(rows, (c - before)[:, None], out=below)
            s = words[:, 0] + words[:, 1]
            s += words[:, 2]
            s += words[:, 3]
            s *= _BYTES
            s >>= _TOP
            s = s.view(np.int64)
            s -= _ONE
            at = lane32 + s
            before = before.astype(np.int64)
            start = (before + flat.take(at, mode="clip")) * unit
            start >>= _16
            start += b1
            at += _ONE
            end = (before + flat.take(at, mode="clip")) * unit
            end >>= _16
            end += b1
            np.putmask(start, is1, b2)
            start *= ~is2
            np.putmask(end, is1, b1)
            np.putmask(end, is2, b2)
            end -= start
            source.take(start, end, r, k)
            group *= GROUP
            s += group
            own = s.astype(np.uint16)
            ranks = leaders >> _U2
            np.putmask(own, is1, ranks[0])
            np.putmask(own, is2, ranks[1])
            x[j] = place[j] = own
            if len(table.rare) > 1:
                few = np.flatnonzero(own == DENSE - 1)
                if few.size:
                    r = source.range[few] // table.rare[-1]
                    v = np.minimum(source.value[few] // r, table.rare[-1] - 1)
                    p = np.searchsorted(table.rare, v, "right") - 1
                    source.take(table.rare[p], table.rare[p + 1] - table.rare[p], r, few)
                    place[j, few] = table.own + p
            own <<= _U2
            own += _U1
            model.lead(own, i1, i2, check, leaders, lead, (leaders ^ own) < _U4)
            x1, x2 = x[j], x1
        model.count(x, c2, hit2, c1, hit1)
        got[k, t : t + STEP] = place.T
    return got
