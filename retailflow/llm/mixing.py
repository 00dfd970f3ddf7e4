"""An adaptive context-mixing range coder for token ids, many blocks in step.

A block carries its sorted distinct ids and how often each comes; the coder sees their places in
that list. Three models predict the next id: the id that followed the last two (order 2), the id
that followed the last one (order 1), both with a confidence, and the block's counts (order 0). The
id of the highest order that has one is the candidate. In the logistic domain, the chance that it
comes is the sum of its share of the counts, with a weight, and of what orders 1 and 2 add by their
confidence; weight and additions learn from every id. A range coder codes whether the candidate
came and, if not, the id by the order-0 counts. Every block starts with an empty model and ends with
its own checksum.

The ids of one block depend on each other, blocks do not, so numpy codes the same place of all
blocks at once. All arithmetic is on integers, so that reader and writer agree on any machine.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np

MAX_BLOCK_IDS = 4096
MAX_LANES = 4096  # blocks that are coded in step, so that memory does not grow with the file
PLACES = 128  # places whose probabilities the writer computes before it codes them
BLOCK = struct.Struct("<IIIII")  # ids, distinct ids, bytes of their list, words of code, crc32 of ids and body
_RENORM = np.uint64(1 << 32)
_U24, _U32 = np.uint64(24), np.uint64(32)
#: ln(p / (1 - p)) of a probability of 12 bits, in 256ths, and the way back.
STRETCH = np.array([round(256 * math.log((2 * p + 1) / (8191 - 2 * p))) for p in range(4096)], dtype=np.int32)
SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], dtype=np.int32)
#: What a confidence of 0 to 15 changes by when another id came, then when its own came.
SURER = np.array([*(-((c + 1) >> 1) for c in range(16)), *(int(c < 15) for c in range(16))], dtype=np.int32)


ADD_RATE, WEIGHT_RATE = 2, 10  # shifts of the error in what is learnt
#: Where the sum's parts start: the weight of order 0, what orders 1 and 2 add by confidence.
START_0 = 1 << 16
START_1 = np.array([2047 + 20 * (c - 4) for c in range(16) for _ in range(2)], dtype=np.int32)
START_2 = np.array([0, *(100 + 60 * c for c in range(15)), *([0] * 16)], dtype=np.int32)


class _Model:
    """The state of all lanes; a lane is a block. Lanes leave from the end."""

    def __init__(self, lengths: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        """``counts`` holds the counts of all lanes' ids, one lane after the other."""
        lanes, width = np.arange(len(sizes)), int(sizes.max())
        held = np.arange(width) < sizes[:, None]
        first = np.cumsum(counts) - counts - np.repeat(np.cumsum(lengths) - lengths, sizes)
        #: counts before it << 13 | its count, by id; and its share in the logistic domain.
        self.table = np.zeros(held.shape, dtype=np.int32)
        self.table[held] = (first << 13) | counts
        self.share = np.zeros(held.shape, dtype=np.int32)
        self.share[held] = STRETCH[np.minimum((counts << 12) // np.repeat(lengths, sizes), 4095)]
        best = (self.table & 8191).argmax(axis=1)
        self.table, self.share = self.table.reshape(-1), self.share.reshape(-1)
        slots = 1 << np.maximum(8, [int(n - 1).bit_length() for n in lengths])
        #: id << 4 | confidence, by the last id, then by a hash of the last two.
        self.orders = np.zeros(len(sizes) * width + int(slots.sum()), dtype=np.uint16)
        self.orders[: len(sizes) * width] = np.repeat(best << 4, width)
        #: What orders 1 and 2 add to the sum in 16ths, by confidence; the first starts from the middle of SQUASH.
        self.adds = np.concatenate([np.tile(START_1, len(sizes)), np.tile(START_2, len(sizes))]) << 4
        self.weight = np.full(len(sizes), START_0, dtype=np.int32)
        self.base, self.base2 = lanes * width, len(sizes) * width + np.cumsum(slots) - slots
        self.base3 = (np.arange(2)[:, None] * len(sizes) + lanes) * 32
        self.mask = slots - 1

    def keep(self, lanes: int) -> None:
        for name in ("base", "base2", "base3", "mask", "weight"):
            setattr(self, name, getattr(self, name)[..., :lanes])
        self.slots = np.empty((2, lanes), dtype=np.int64)

    def contexts(self, before: np.ndarray, last: np.ndarray, out: np.ndarray) -> None:
        """Places of the two orders' entries after the ids ``before`` and ``last``."""
        np.add(self.base, last, out=out[..., 0, :])
        np.add(self.base2, (before * 2971 + last * 911) & self.mask, out=out[..., 1, :])

    def predict(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidate of each lane and the probability, of 4096, that it comes."""
        self.at = at
        self.seen = self.orders.take(at).astype(np.int32)
        self.ids, self.sure = self.seen >> 4, self.seen & 15
        candidate = np.where(self.sure[1] > 0, self.ids[1], self.ids[0])
        self.stretched = self.share.take(self.base + candidate)
        context = self.sure[0] << 1
        context += self.ids[0] == candidate
        slots = self.slots
        np.add(self.base3[0], context, out=slots[0])
        np.add(self.base3[1], self.sure[1], out=slots[1])
        self.added = self.adds.take(slots)
        dot = self.weight * self.stretched
        dot >>= 12
        dot += self.added[0]
        dot += self.added[1]
        dot >>= 4
        self.chosen = SQUASH.take(dot, mode="clip")
        return candidate, self.chosen

    def update(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """Learn from the ids (32 bit) that came, ``hit`` where they were the candidates."""
        error = np.left_shift(hit, 12, dtype=np.int32)
        error -= self.chosen
        self.stretched *= error
        self.stretched >>= WEIGHT_RATE
        self.weight += self.stretched
        error >>= ADD_RATE
        self.added += error
        self.adds[self.slots] = self.added
        self.sure += np.left_shift(self.ids == ids, 4, dtype=np.int32)
        self.seen += SURER.take(self.sure)
        self.orders[self.at] = np.where(self.sure < 2, (ids << 4) | 1, self.seen)


def _phases(lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """``(from, to, lanes)``: how many lanes still run at which places; lengths fall."""
    out, at = [], 0
    for end in sorted(set(lengths.tolist())):
        out.append((at, end, int((lengths >= end).sum())))
        at = end
    return out


def _scale(lengths: np.ndarray) -> np.ndarray:
    """What a count of an order-0 model is worth, in 128ths, where all are worth 4096."""
    return ((1 << 19) // lengths).astype(np.int32)


def _encode_lanes(ids: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Code words of lanes of local ids; ``ids[t]`` holds place t of all lanes."""
    lanes = len(lengths)
    model = _Model(lengths, sizes, counts)
    low, span = np.zeros(lanes, dtype=np.uint64), np.full(lanes, np.iinfo(np.uint64).max)
    words, used = np.zeros((lanes, int(lengths.max()) + 2), dtype=np.uint32), np.zeros(lanes, dtype=np.int64)

    def emit(who: np.ndarray) -> None:
        words[who, used[who]] = low[who] >> _U32
        used[who] += 1
        low[who] <<= _U32

    for start, end, lanes in _phases(lengths):
        model.keep(lanes)
        a, b = low[:lanes], span[:lanes]
        for t in range(start, end, PLACES):
            now = ids[t : min(t + PLACES, end), :lanes]
            earlier = np.zeros((len(now) + 2, lanes), dtype=np.int64)
            earlier[max(0, 2 - t) :] = ids[max(0, t - 2) : t + len(now), :lanes]
            at = np.empty((len(now), 2, lanes), dtype=np.int64)
            model.contexts(earlier[:-2], earlier[1:-1], at)
            hits, chances = np.empty(now.shape, dtype=bool), np.empty(now.shape, dtype=np.int32)
            for n in range(len(now)):
                candidate, chances[n] = model.predict(at[n])
                np.equal(candidate, now[n], out=hits[n])
                model.update(now[n], hits[n])
            entry = model.table.take(model.base + now)
            unit = ((4096 - chances) * _scale(lengths[:lanes])) >> 7
            skips = (((chances << 12) + unit * (entry >> 13)) * ~hits).astype(np.uint64)
            shares = np.where(hits, chances << 12, unit * (entry & 8191)).astype(np.uint64)
            for skip, share in zip(skips, shares):
                b >>= _U24
                skip *= b
                b *= share
                a += skip
                carry = np.flatnonzero(a < skip)
                if len(carry):  # into the words that are out already
                    place = used[carry]
                    while len(carry):
                        place = place - 1
                        words[carry, place] += np.uint32(1)
                        again = words[carry, place] == 0
                        carry, place = carry[again], place[again]
                small = np.flatnonzero(b < _RENORM)
                if len(small):
                    emit(small)
                    b[small] <<= _U32
    everyone = np.arange(len(lengths))
    emit(everyone)
    # The last word of zeros is implied; so are further ones.
    emit(everyone)
    return [w[:n] for w, n in zip(words, used)]


def _decode_lanes(words: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Local ids, ``[t]`` the place t of all lanes; ``words`` holds a row of code words for each lane."""
    lanes = len(lengths)
    model = _Model(lengths, sizes, counts)
    ids = np.zeros((int(lengths.max()), lanes), dtype=np.int32)
    #: The id at each of a lane's counts, one lane after the other.
    held = np.arange(len(counts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held = np.repeat(held.astype(np.int32), counts)
    ends = np.cumsum(lengths)
    left = (words[:, 0].astype(np.uint64) << _U32) | words[:, 1]
    span, used = np.full(lanes, np.iinfo(np.uint64).max), np.full(lanes, 2)
    words, row = words.reshape(-1), np.arange(lanes) * words.shape[1]
    most = words.size // lanes - 1
    for start, end, lanes in _phases(lengths):
        model.keep(lanes)
        a, b = left[:lanes], span[:lanes]
        first, last_one, scale = ends[:lanes] - lengths[:lanes], lengths[:lanes] - 1, _scale(lengths[:lanes])
        at, nothing = np.empty((2, lanes), dtype=np.int64), np.zeros(lanes, dtype=np.int32)
        for t in range(start, end):
            last, before = (ids[t - 1, :lanes] if t else nothing), (ids[t - 2, :lanes] if t > 1 else nothing)
            model.contexts(before, last, at)
            now, chosen = model.predict(at)
            b >>= _U24
            over = np.minimum(a // b, 0xFFFFFF).astype(np.int32)
            bound = chosen << 12
            hit = over < bound
            over -= bound
            unit = ((4096 - chosen) * scale) >> 7
            place = np.minimum(over.view(np.uint32) // unit.view(np.uint32), last_one)
            now = np.where(hit, now, held.take(first + place))
            entry = model.table.take(model.base + now)
            skip = (unit * (entry >> 13) + bound) * ~hit
            a -= skip.astype(np.uint64) * b
            b *= np.where(hit, bound, unit * (entry & 8191)).astype(np.uint64)
            small = np.flatnonzero(b < _RENORM)
            if len(small):
                place = used[small]
                used[small] = place + 1
                a[small] = (a[small] << _U32) | words[row[small] + np.minimum(place, most)]
                b[small] <<= _U32
            ids[t, :lanes] = now
            model.update(ids[t, :lanes], hit)
    return ids


def _pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of seven bits and a mark for more, lowest first; also the size of each value."""
    sizes = 1 + sum((values >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        has = sizes > k
        out[(ends - sizes)[has] + k] = ((values[has] >> (7 * k)) & 127) | np.where(sizes[has] > k + 1, 128, 0)
    return out, sizes


def _unpack_numbers(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data < 128)
    firsts = np.concatenate([[0], last[:-1] + 1])
    places = np.arange(len(data)) - np.repeat(firsts, last - firsts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * places), firsts)


def _few(sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Blocks whose counts are listed; in others, marks tell where the sorted ids change."""
    return 16 * sizes <= lengths


def _pieces(data: bytes, sizes: np.ndarray) -> list[bytes]:
    ends = np.cumsum(sizes).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def encode_blocks(ids: np.ndarray, block_ids: int) -> bytes:
    """Token ids (unsigned, 32 bit) as blocks of ``block_ids``, 4096 at most, one after the other."""
    if not 0 < block_ids <= MAX_BLOCK_IDS:
        raise ValueError(f"a block holds 1 to {MAX_BLOCK_IDS} ids")
    if not len(ids):
        return b""
    step = block_ids * MAX_LANES
    return b"".join(_encode_group(ids[n : n + step], block_ids) for n in range(0, len(ids), step))


def _encode_group(ids: np.ndarray, block_ids: int) -> bytes:
    lengths = np.full(-(-len(ids) // block_ids), block_ids)
    lengths[-1] = len(ids) - block_ids * (len(lengths) - 1)
    pad = block_ids - lengths[-1]
    # The last block is filled up with its largest id, which sorts behind all others.
    rows = np.append(ids, np.full(pad, ids[len(ids) - lengths[-1] :].max(), dtype=ids.dtype)).reshape(-1, block_ids)
    ordered = np.sort(rows, axis=1)
    new = np.ones(rows.shape, dtype=bool)
    np.not_equal(ordered[:, 1:], ordered[:, :-1], out=new[:, 1:])
    sizes, starts = new.sum(axis=1), np.flatnonzero(new)
    known = ordered.reshape(-1)[starts].astype(np.int64)
    counts = np.diff(starts, append=rows.size)
    counts[-1] -= pad
    steps, firsts = np.diff(known, prepend=0), np.cumsum(sizes) - sizes
    steps[firsts] = known[firsts]
    few = _few(sizes, lengths)
    listed, widths = _pack_numbers(steps)
    lists = _pieces(listed.tobytes(), np.add.reduceat(widths, firsts))
    more, widths = _pack_numbers(counts[np.repeat(few, sizes)])
    often = iter(_pieces(more.tobytes(), np.add.reduceat(widths, np.cumsum(sizes[few]) - sizes[few]) if few.any() else sizes[:0]))
    marks = np.packbits(new, axis=1)
    local = np.empty(rows.shape, dtype=np.int32)
    place = np.zeros(int(known.max()) + 1, dtype=np.int32) if known.max() < 1 << 22 else None
    for row, block, first, size in zip(local, rows, firsts.tolist(), sizes.tolist()):
        if place is None:
            row[:] = known[first : first + size].searchsorted(block)
        else:
            place[known[first : first + size]] = np.arange(size, dtype=np.int32)
            place.take(block, out=row, mode="clip")
    code = _encode_lanes(np.ascontiguousarray(local.T), lengths, sizes, counts)
    out = []
    packed = memoryview(ids.astype("<u4").tobytes())
    for n, words in enumerate(code):
        head = lists[n] + (next(often) if few[n] else marks[n, : -(-lengths[n] // 8)].tobytes())
        body = head + words.astype("<u4").tobytes()
        check = zlib.crc32(body, zlib.crc32(packed[4 * n * block_ids : 4 * (n + 1) * block_ids]))
        out.append(BLOCK.pack(lengths[n], sizes[n], len(head), len(words), check))
        out.append(body)
    return b"".join(out)


def _known_ids(lists: list[bytes], lengths: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct ids of all blocks and their counts, one block after the other."""
    few = _few(sizes, lengths)
    marks = np.where(few, 0, -(-lengths // 8))
    if (sizes < 1).any() or (marks >= [len(x) for x in lists]).any():
        raise ValueError("a block's list of ids is damaged")
    parts = [x[: len(x) - m] for x, m in zip(lists, marks.tolist())]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    found = np.cumsum(data < 128)[ends - 1]
    if (data[ends - 1] > 127).any() or (np.diff(found, prepend=0) != sizes * (1 + few)).any():
        raise ValueError("a block's list of ids is damaged")
    numbers = _unpack_numbers(data)
    owner = np.repeat(np.arange(len(sizes)), sizes * (1 + few))
    is_count = np.arange(len(numbers)) - (found - sizes * (1 + few))[owner] >= sizes[owner]
    known = np.cumsum(numbers[~is_count])
    firsts = np.cumsum(sizes) - sizes
    known -= np.repeat(np.append(0, known)[firsts], sizes)
    bits = np.unpackbits(np.frombuffer(b"".join(x[len(x) - m :] for x, m in zip(lists, marks.tolist()) if m), np.uint8))
    marked = lengths[~few]
    spread = np.repeat(np.cumsum(8 * marks[~few]) - 8 * marks[~few], marked)
    bits = bits[spread + np.arange(len(spread)) - np.repeat(np.cumsum(marked) - marked, marked)]
    bits[np.cumsum(marked) - marked] = 1
    counts, in_few = np.empty(len(known), dtype=np.int64), np.repeat(few, sizes)
    places = np.flatnonzero(bits)
    if len(places) != np.count_nonzero(~in_few):
        raise ValueError("a block's list of ids is damaged")
    counts[in_few], counts[~in_few] = numbers[is_count], np.diff(places, append=len(bits))
    if counts.min() < 1 or (np.add.reduceat(counts, firsts) != lengths).any():
        raise ValueError("a block's list of ids is damaged")
    return known, counts


def _decode_group(found: list[tuple]) -> Iterator[np.ndarray]:
    """The ids of blocks in falling order of their length."""
    lengths, sizes = (np.array([f[k] for f in found]) for k in (0, 1))
    known, counts = _known_ids([f[2] for f in found], lengths, sizes)
    words = np.zeros((len(found), max(len(f[3]) for f in found) // 4), dtype=np.uint32)
    for row, f in zip(words, found):
        row[: len(f[3]) // 4] = np.frombuffer(f[3], "<u4")
    local = np.ascontiguousarray(_decode_lanes(words, lengths, sizes, counts).T)
    for row, first, (length, size, listed, code, check, _) in zip(local, (np.cumsum(sizes) - sizes).tolist(), found):
        ids = known[first : first + size].take(row[:length]).astype("<u4")
        if zlib.crc32(code, zlib.crc32(listed, zlib.crc32(ids))) != check:
            raise ValueError("a block does not match its checksum")
        yield ids


def decode_blocks(streams: list[bytes]) -> list[np.ndarray]:
    """The ids of each stream of blocks; raises where a block does not match its checksum."""
    found = []
    for owner, data in enumerate(streams):
        at = 0
        while at < len(data):
            if at + BLOCK.size > len(data):
                raise ValueError("a block is cut short")
            length, size, listed, n_words, check = BLOCK.unpack_from(data, at)
            start, end = at + BLOCK.size, at + BLOCK.size + listed + 4 * n_words
            if end > len(data) or not 0 < length <= MAX_BLOCK_IDS or size > length or n_words < 2:
                raise ValueError("a block is cut short")
            found.append((length, size, data[start : start + listed], data[start + listed : end], check, owner))
            at = end
    if not found:
        return [np.zeros(0, dtype="<u4") for _ in streams]
    order = sorted(range(len(found)), key=lambda n: -found[n][0])
    blocks: list = [None] * len(order)
    for n in range(0, len(order), MAX_LANES):
        group = order[n : n + MAX_LANES]
        for place, block in zip(group, _decode_group([found[k] for k in group])):
            blocks[place] = block
    out: list[list] = [[np.zeros(0, dtype="<u4")] for _ in streams]
    for (*_, owner), block in zip(found, blocks):
        out[owner].append(block)
    return [np.concatenate(parts) for parts in out]
