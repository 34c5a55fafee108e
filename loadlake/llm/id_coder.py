"""An adaptive range coder for blocks of token ids; many blocks are coded side by side.

A block is independent of all others. Its ids are numbered in the order in which they first appear; three models predict
the next number: the one that followed the last two (order 2), the one that followed the last one (order 1), each with a
confidence, and counts of all numbers so far, with a share for new ones (order 0). The share of each model is learned per
pair of confidences. All shares together are one distribution, of which a range coder takes the part of the number that
comes; a new id is spelled out evenly. An id that a prediction names is coded by that prediction's share alone.

The models of all blocks (lanes) advance together, step by step, as numpy arrays. Blocks are short so that the models of
all lanes, some 7 kB each, stay in a core's cache.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1024
LANES = 1024
#: Number of ids, largest id (new ids are spelled out up to it), number of 16-bit words, crc32 of the ids.
HEADER = struct.Struct("<IIII")
_TOTAL_BITS = 20
_TOTAL = 1 << _TOTAL_BITS
_LEAST = 1 << 14  # what order 0 has at least; more than its counts
_SLOTS = 1024
_U = np.uint64
_BITS, _LOW, _TOP, _WORD, _ONE = _U(_TOTAL_BITS), _U(1 << 32), _U(48), _U(16), _U(1)
_WORDS_PER_ID = 3
#: Digits of a number below ``BLOCK``: their shifts and sizes.
_DIGITS = ((6, 16), (2, 16), (0, 4))
_BELOW = [np.tri(size, size, -1, dtype=np.int16) for _, size in _DIGITS]
_ROOM = np.array([[c >> 2, c & 3, 2, 2 + (c >> 2) + (c & 3)] for c in range(16)], np.int32)


class Counts:
    """Counts of numbers below ``BLOCK`` in each lane, summed at three levels."""

    def __init__(self, lanes: int):
        self.levels = [np.zeros((lanes * rows, size), np.int16) for rows, (_, size) in zip((1, 16, 256), _DIGITS, strict=True)]

    def before(self, lane: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of all smaller numbers, and that of the number."""
        row = lane
        total = np.zeros(len(lane), np.int64)
        for level, (shift, size), below in zip(self.levels, _DIGITS, _BELOW, strict=True):
            d = number >> shift & (size - 1)
            total += np.einsum("ij,ij->i", level[row], below[d])
            own = level.ravel()[row * size + d]
            row = row * size + d
            if shift:
                row = lane * (BLOCK >> shift) + (number >> shift)
        return total, own

    def find(self, lane: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number that holds the target-th count, the count of all smaller ones, and its own."""
        left, number = target.copy(), np.zeros(len(lane), np.int64)
        for level, (shift, size) in zip(self.levels, _DIGITS, strict=True):
            row = lane * (BLOCK >> shift) // size + number
            counts = level[row]
            sums = np.cumsum(counts, axis=1, dtype=np.int16)
            d = np.count_nonzero(sums <= left[:, None], axis=1)
            own = counts.ravel()[np.arange(0, counts.size, size) + d]
            left -= sums.ravel()[np.arange(0, counts.size, size) + d] - own
            number = number * size + d
        return number, target - left, own

    def add(self, base: np.ndarray, number: np.ndarray) -> None:
        """``base`` is the lane times ``BLOCK``."""
        both = base + number
        for level, (shift, _) in zip(self.levels, _DIGITS, strict=True):
            level.ravel()[both >> shift] += 1


class Models:
    """What has been learned in each lane, and the predictions that follow."""

    def __init__(self, lanes: int):
        self.one = np.zeros(lanes * (BLOCK + 1), np.uint16)  # by the last number: (number + 1) * 4 + confidence
        self.two = np.zeros(lanes * _SLOTS, np.uint16)
        self.counts = Counts(lanes)
        self.distinct = np.zeros(lanes, np.int64)
        self.shares = np.tile(_ROOM, (lanes, 1))
        self.last = np.full(lanes, BLOCK, np.int64)
        self.before = np.full(lanes, BLOCK, np.int64)
        self.lane = np.arange(lanes)
        self.base = self.lane * BLOCK
        self.base_one = self.lane * (BLOCK + 1)
        self.base_context = self.lane * 16

    def predict(self, n: int) -> tuple[np.ndarray, ...]:
        """Of the first n lanes: the numbers predicted by order 2 and order 1 (-1: none), and their parts of the total."""
        last = self.last[:n]
        self.at_one = self.base_one[:n] + last
        self.at_two = self.base[:n] + ((last * 0x9E35 + self.before[:n] * 0x79B1) >> 3 & (_SLOTS - 1))
        self.state_one, self.state_two = self.one[self.at_one].astype(np.int32), self.two[self.at_two].astype(np.int32)
        a, b = (self.state_two >> 2) - 1, (self.state_one >> 2) - 1
        self.context = self.base_context[:n] + ((self.state_two & 3) << 2 | self.state_one & 3)
        shares = self.shares[self.context]
        unit = (_TOTAL - _LEAST) / shares[:, 3]
        part_a, part_b = (shares[:, 0] * unit).astype(np.int64), (shares[:, 1] * unit).astype(np.int64)
        same = a == b
        part_a += part_b * same
        part_b *= ~same
        return a, b, part_a, part_b

    def learn(self, n: int, number: np.ndarray, outcome: np.ndarray) -> None:
        """The number that came in each of the first n lanes, by which model (0: order 2, 1: order 1, 2: order 0)."""
        flat = self.shares.ravel()
        flat[self.context * 4 + outcome] += 1
        flat[self.context * 4 + 3] += 1
        fresh = (number + 1) << 2 | 1
        for table, at, state in ((self.one, self.at_one, self.state_one), (self.two, self.at_two, self.state_two)):
            trust = state & 3
            wrong = np.where(trust > 1, state - trust + (trust >> 1), fresh)
            table[at] = np.where(state >> 2 == fresh >> 2, state + (trust < 3), wrong)
        self.counts.add(self.base[:n], number)
        np.maximum(self.distinct[:n], number + 1, out=self.distinct[:n])
        self.before[:n] = self.last[:n]
        self.last[:n] = number


def local_numbers(ids: np.ndarray) -> np.ndarray:
    """Each row's ids as numbers by first appearance."""
    ids = ids.astype(np.uint16) if ids.size and ids.max() < 1 << 16 else ids
    order = np.argsort(ids, axis=1, kind="stable")
    ordered = np.take_along_axis(ids, order, axis=1)
    new = np.ones(ids.shape, bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    rows, places = np.nonzero(new)
    firsts = order[rows, places]
    is_first = np.zeros(ids.shape, bool)
    is_first[rows, firsts] = True
    starts = is_first.cumsum(axis=1, dtype=np.int32)[rows, firsts] - 1
    out = np.empty(ids.shape, np.int32)
    np.put_along_axis(out, order, starts[np.cumsum(new.ravel()) - 1].reshape(ids.shape), axis=1)
    return out


class _Range:
    """Low end and width of each lane's range; ``move`` is told which lanes have settled a word."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, _U)
        self.range = np.full(lanes, (1 << 64) - 1, _U)

    def narrow(self, lane: np.ndarray, first: np.ndarray, width: np.ndarray, unit: np.ndarray) -> None:
        """Take ``width`` units from ``first``; widen what became too narrow."""
        self.low[lane] += first.astype(_U) * unit
        self.range[lane] = width.astype(_U) * unit
        while len(lane):
            low, span = self.low[lane], self.range[lane]
            same = (low ^ (low + span)) >> _TOP == 0
            send = np.flatnonzero(same | (span < _LOW))
            if not len(send):
                return
            lane, low, span, same = lane[send], low[send], span[send], same[send]
            self.move(lane, low)
            self.low[lane] = low << _WORD
            self.range[lane] = np.where(same, span, (~low + _ONE) & (_LOW - _ONE)) << _WORD

    def move(self, lane: np.ndarray, low: np.ndarray) -> None:
        raise NotImplementedError


class Encoder(_Range):
    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes)
        self.words = np.zeros((lanes, steps * _WORDS_PER_ID + 16), np.uint16)
        self.used = np.zeros(lanes, np.int64)

    def move(self, lane: np.ndarray, low: np.ndarray) -> None:
        used = self.used[lane]
        self.words[lane, used] = low >> _TOP
        self.used[lane] = used + 1


class Decoder(_Range):
    def __init__(self, words: np.ndarray):
        super().__init__(len(words))
        self.words = words
        self.used = np.full(len(words), 4)
        self.code = np.zeros(len(words), _U)
        for k in range(4):
            self.code = self.code << _WORD | words[:, k].astype(_U)

    def move(self, lane: np.ndarray, low: np.ndarray) -> None:
        used = self.used[lane]
        self.code[lane] = self.code[lane] << _WORD | self.words[lane, np.minimum(used, self.words.shape[1] - 1)]
        self.used[lane] = used + 1

    def value(self, lane: np.ndarray, unit: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.minimum((self.code[lane] - self.low[lane]) // unit, (total - 1).astype(_U)).astype(np.int64)


def encode_blocks(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Each row's first ``lengths`` ids as a block. Rows are in order of falling length, at most ``BLOCK`` wide."""
    lanes, steps = len(ids), int(lengths.max(initial=0))
    numbers = local_numbers(ids[:, :steps]).T.astype(np.int64)
    columns = ids[:, :steps].T.copy()
    alphabet = np.where(np.arange(ids.shape[1])[None, :] < lengths[:, None], ids, 0).max(axis=1, initial=0).astype(_U) + _ONE
    models, coder = Models(lanes), Encoder(lanes, steps)
    for step in range(steps):
        n = int(np.searchsorted(-lengths, -step, "left"))  # lanes with more ids than this
        number = numbers[step, :n]
        a, b, part_a, part_b = models.predict(n)
        by_a, by_b = number == a, number == b
        outcome = np.where(by_a, 0, 2 - (by_b & ~by_a))
        first = np.where(by_a, 0, part_a)
        width = np.where(by_a, part_a, part_b)
        other = np.flatnonzero(outcome == 2)
        rest = part_a[other] + part_b[other]
        distinct = models.distinct[other]
        is_new = number[other] == distinct
        total = step + 1 + distinct  # a share for new ones that grows with how many different ones there are
        before, own = np.full(len(other), step), distinct + 1
        old = np.flatnonzero(~is_new)
        before[old], own[old] = models.counts.before(other[old], number[other[old]])
        start = (_TOTAL - rest) * before // total
        first[other] = rest + start
        width[other] = (_TOTAL - rest) * (before + own) // total - start
        coder.narrow(models.lane[:n], first, width, coder.range[:n] >> _BITS)
        fresh = other[is_new]
        if len(fresh):
            coder.narrow(fresh, columns[step, fresh], np.ones(len(fresh), _U), coder.range[fresh] // alphabet[fresh])
        models.learn(n, number, outcome)
    out = []
    for lane in range(lanes):
        low, used, n = int(coder.low[lane]), int(coder.used[lane]), int(lengths[lane])
        tail = np.array([low >> s & 0xFFFF for s in (48, 32, 16, 0)], "<u2")
        crc = zlib.crc32(ids[lane, :n].astype("<u4").tobytes())
        head = HEADER.pack(n, int(alphabet[lane]) - 1, used + 4, crc)
        out.append(head + coder.words[lane, :used].astype("<u2").tobytes() + tail.tobytes())
    return out


def decode_blocks(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of blocks that are in order of falling length."""
    heads = [HEADER.unpack_from(b) for b in blocks]
    lengths = np.array([h[0] for h in heads], np.int64)
    alphabet = np.array([h[1] + 1 for h in heads], np.int64)
    lanes, steps = len(blocks), int(lengths.max(initial=0))
    words = np.zeros((lanes, max(h[2] for h in heads) + 1), np.uint16)
    for lane, (block, head) in enumerate(zip(blocks, heads, strict=True)):
        words[lane, : head[2]] = np.frombuffer(block, "<u2", head[2], HEADER.size)
    models, coder = Models(lanes), Decoder(words)
    id_of = np.zeros(lanes * BLOCK, np.uint32)
    out = np.zeros((steps, lanes), np.uint32)
    whole = np.full(lanes, _TOTAL)
    for step in range(steps):
        n = int(np.searchsorted(-lengths, -step, "left"))
        lane = models.lane[:n]
        a, b, part_a, part_b = models.predict(n)
        unit = coder.range[:n] >> _BITS
        value = coder.value(lane, unit, whole[:n])
        both = part_a + part_b
        by_a, not_other = value < part_a, value < both
        outcome = np.where(by_a, 0, 2 - (not_other & ~by_a))
        number = np.where(by_a, a, b).astype(np.int64)
        first = np.where(by_a, 0, part_a)
        width = np.where(by_a, part_a, part_b)
        other = np.flatnonzero(outcome == 2)
        rest = both[other]
        distinct = models.distinct[other]
        total = step + 1 + distinct
        target = ((value[other] - rest + 1) * total - 1) // (_TOTAL - rest)
        is_new = target >= step
        found, before, own = distinct, np.full(len(other), step), distinct + 1
        old = np.flatnonzero(~is_new)
        found[old], before[old], own[old] = models.counts.find(other[old], target[old])
        start = (_TOTAL - rest) * before // total
        first[other] = rest + start
        width[other] = (_TOTAL - rest) * (before + own) // total - start
        number[other] = found
        coder.narrow(lane, first, width, unit)
        fresh = other[is_new]
        if len(fresh):
            unit = coder.range[fresh] // alphabet[fresh].astype(_U)
            new = coder.value(fresh, unit, alphabet[fresh])
            coder.narrow(fresh, new, np.ones(len(fresh), _U), unit)
            id_of[models.base[fresh] + number[fresh]] = new
        out[step, :n] = id_of[models.base[:n] + number]
        models.learn(n, number, outcome)
    ids = [out[:n, lane].astype("<u4") for lane, n in enumerate(lengths.tolist())]
    for row, head in zip(ids, heads, strict=True):
        if zlib.crc32(row.tobytes()) != head[3]:
            raise ValueError("a block of token ids is damaged")
    return ids


def encode(ids: np.ndarray) -> bytes:
    """Ids as blocks of ``BLOCK``, the last one shorter; some ``LANES`` blocks at a time."""
    out = []
    for at in range(0, len(ids), BLOCK * LANES):
        some = ids[at : at + BLOCK * LANES]
        lengths = np.diff(np.r_[np.arange(0, len(some), BLOCK), len(some)])
        rows = np.zeros(len(lengths) * BLOCK, np.uint32)
        rows[: len(some)] = some
        width = BLOCK if len(lengths) > 1 else len(some)
        out += encode_blocks(rows.reshape(-1, BLOCK)[:, :width], lengths)
    return b"".join(out)


def decode(payload: bytes) -> np.ndarray:
    blocks, at = [], 0
    while at < len(payload):
        end = at + HEADER.size + 2 * HEADER.unpack_from(payload, at)[2]
        blocks.append(payload[at:end])
        at = end
    ids = [row for k in range(0, len(blocks), LANES) for row in decode_blocks(blocks[k : k + LANES])]
    return np.concatenate(ids) if ids else np.zeros(0, "<u4")
