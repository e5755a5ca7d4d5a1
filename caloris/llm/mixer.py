"""Online logistic mixing of hashed-context bit predictors, for many texts at once.

Symbols: a text is its bytes and an end. The 31 bytes that a corpus uses most take one unit of five bits; any other byte and the end
take an escape unit and two units for its halves (the first bit of these is always 0). Each bit is a decision at a node of the tree
of the units seen so far, so probabilities over all texts add up to one.

Predictors: a table for each context (the last byte, the last two, the last three, the word so far), hashed together with the node; a
slot holds the log odds of what followed in the corpus, weighed by how often. A gate, the bit's place in its unit, chooses among five
sets of weights; the weighted sum is squashed to a probability and, as soon as the bit is known, the chosen weights move by its
error. An adaptive map from mixed to observed probabilities refines the result; the mean of both is what a bit costs.

State along a text: weights and maps adapt from bit to bit within a block of BLOCK units. The blocks of a text stand in levels of 1,
1, 2, 4, 8, ... blocks; those of a level start from the mean of the states in which the blocks of the level before end. So what a bit
costs depends on the text before it alone, states are handed on to the end of the text, and the blocks of a level run side by side.
Contexts reach across blocks; texts run in pieces of PIECE bytes that hand their sums on, so that memory is bounded for a text of any
length.

Kinds: units that are equal behind equal contexts are of a kind (about one in nine in 4 MB of text). Contexts are hashed and tables looked
up once a kind; the loop over units takes a kind's predictions in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np

BLOCK, PIECE = 1024, 1 << 20
#: Bytes coded side by side, bytes whose contexts are computed at a time, blocks in one array, steps whose inputs are gathered at a time.
GROUP, SLICE, LANES, STEPS = 4 << 20, 1 << 19, 1024, 32
#: Kinds of units whose predictions are held at once, 32 bytes each, where there is more than one text.
KINDS = 1 << 22
RATE, MAP_RATE, MAP_CELLS = 0.02, 0.02, 64
START_WEIGHT = 0.35
#: Log odds are held in eight bits, in steps of 1 / SCALE.
SCALE = 14.0
COMMON, ESCAPE, NODE_BITS = 31, 31, 10
#: What a node that can't be otherwise predicts.
SURE = -127
_ODD, _FIRST, _SECOND, _MIX = 0x01000193, 0x9E3779B1, 0x85EBCA6B, 0x9E3779B97F4A7C15
_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Shape:
    """common: the bytes of one unit, at most 31. bits: of the slots of the last three tables; the first has a slot for each case."""

    common: bytes
    bits: tuple[int, int, int] = (18, 19, 20)

    @cached_property
    def sizes(self) -> tuple[int, ...]:
        return (1 << (8 + NODE_BITS), *(1 << b for b in self.bits))

    @cached_property
    def starts(self) -> tuple[int, ...]:
        return tuple(int(x) for x in np.cumsum((0, *self.sizes))[:-1])

    @property
    def total(self) -> int:
        return sum(self.sizes)

    @cached_property
    def unit(self) -> np.ndarray:
        """The first unit of each byte."""
        out = np.full(256, ESCAPE, np.uint8)
        out[list(self.common)] = np.arange(len(self.common))
        return out

    @property
    def end(self) -> int:
        """What stands for the end behind an escape, where common bytes never stand."""
        return self.common[0]


def shape(byte_counts: np.ndarray, n_bytes: int) -> Shape:
    """For a corpus of n_bytes that holds each byte so often. The hashed tables double with each eightfold of the corpus."""
    order = np.lexsort((np.arange(256), -byte_counts))
    common = bytes(int(b) for b in order[:COMMON])
    more = round(np.log2(max(1, n_bytes) / 5e8) / 3)
    return Shape(common, tuple(max(12, b + more) for b in (18, 19, 20)))


def pieces(raw: bytes) -> Iterator[tuple[bytes, bytes, bool]]:
    """The text's bytes, at most PIECE at a time, each with the three bytes before it, and whether the text ends with it."""
    for at in range(0, max(1, len(raw)), PIECE):
        yield (b"\0\0\0" + raw[:at])[-3:] if at < 3 else raw[at - 3 : at], raw[at : at + PIECE], at + PIECE >= len(raw)


@dataclass
class Units:
    """The units of pieces, one after the other, as numbers of kinds, and each piece's number of units. Units of a kind follow the same
    bytes and the same start of a word. Of kinds: codes, the nodes that they start from, the last three bytes (the last one lowest),
    the word's hash."""

    kind: np.ndarray
    sizes: np.ndarray
    code: np.ndarray
    base: np.ndarray
    bytes: np.ndarray
    word: np.ndarray

    @property
    def contexts(self) -> list[np.ndarray]:
        """The contexts of the four tables."""
        return [self.bytes & np.uint32(0xFF), self.bytes & np.uint32(0xFFFF), self.bytes, self.word]


def units(parts: list[tuple[bytes, bytes, bool]], form: Shape, most: int = 1 << 31) -> Units | None:
    """None if there are more kinds than that."""
    made, held, size = [], [], 0
    for part in parts:
        held.append(part)
        size += len(part[1])
        if size >= SLICE:
            made.append(_keys(held))
            held, size = [], 0
    if held:
        made.append(_keys(held))
    key, sizes = (np.concatenate([m[i] for m in made]) if len(made) > 1 else made[0][i] for i in (0, 1))
    del made
    n, byte = len(key), key.astype(np.uint8)
    edges = np.cumsum(np.r_[0, sizes])
    closing = (edges[1:] - 1)[[ends for _, _, ends in parts]]
    alike = _alike(key)
    # an end stands as a zero in its key: each of these is a kind of its own
    zero = np.flatnonzero(byte == 0)
    alike[zero] = zero
    own = np.flatnonzero(alike == np.arange(n, dtype=np.int32))
    some, first = key[own], form.unit[byte[own]]
    ends = np.searchsorted(own, closing)
    first[ends] = ESCAPE
    times = np.where(first == ESCAPE, np.int32(3), np.int32(1))
    if times.sum() > most:
        return None
    start = np.cumsum(times, dtype=np.int32) - times
    of = np.repeat(np.arange(len(own), dtype=np.int32), times)
    code, base, last = first[of], np.zeros(len(of), np.uint16), (some.astype(np.uint32) >> np.uint32(8))[of]
    escape = start[first == ESCAPE]
    value = byte[own]
    value[ends] = form.end
    value = value[first == ESCAPE]
    code[escape + 1], base[escape + 1] = value >> 4, 32
    code[escape + 2], base[escape + 2] = value & 15, 64 + 32 * (value >> 4).astype(np.uint16)
    # each byte's first unit, and room for two more behind an escape
    number = np.empty(n, np.int32)
    number[own] = start
    kind = number.take(alike, mode="clip")
    rare = form.unit[byte] == ESCAPE
    rare[closing] = True
    rare = np.flatnonzero(rare)
    at = rare + 2 * np.arange(len(rare))
    free = np.ones(n + 2 * len(rare), bool)
    free[at + 1] = free[at + 2] = False
    out = np.empty(len(free), np.int32)
    out[free] = kind
    out[at + 1], out[at + 2] = out[at] + 1, out[at] + 2
    return Units(out, sizes + 2 * np.diff(np.searchsorted(rare, edges)), code, base, last, (some >> np.uint64(32)).astype(np.uint32)[of])


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of _ODD, and of its inverse, in 32 bits."""
    out = []
    for x in (_ODD, pow(_ODD, -1, 1 << 32)):
        power = np.full(n, x, np.uint32)
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


def _keys(parts: list[tuple[bytes, bytes, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of pieces, and a zero for a text's end: the word's hash, the three bytes before and the byte, in 64 bits. The number
    of these for each piece."""
    # a byte more stands for the end of a piece, whether or not the text ends there
    data = np.frombuffer(b"".join(before + body + b"\0" for before, body, _ in parts), np.uint8)
    n = len(data)
    sizes = np.array([len(body) + 1 for _, body, _ in parts])
    begins = np.cumsum(sizes + 3) - sizes
    wide = data.astype(np.uint32)
    key = wide.copy()
    for k in (1, 2, 3):
        key[k:] |= wide[:-k] << np.uint32(8 * k)
    # the word so far: sums of bytes times powers, taken from the word's start and shifted back to it
    power, back = _powers(1 << (n - 1).bit_length())
    wide += np.uint32(1)
    wide *= power[:n]
    sums = np.cumsum(wide, dtype=np.uint32)
    sums -= wide
    fresh = np.ones(n, bool)
    fresh[1:] = _BREAK[data[:-1]]
    fresh[begins] = True
    place = np.flatnonzero(fresh)
    length = np.diff(place, append=n)
    # what a word's bytes share: its sum so far, the power to shift back by, its place
    sums -= np.repeat(sums[place], length)
    sums *= np.repeat(back[place], length)
    sums ^= (np.arange(n, dtype=np.uint32) - np.repeat(place.astype(np.uint32), length)) << np.uint32(7)
    sums *= np.uint32(_SECOND)
    both = np.empty((n, 2), "<u4")
    both[:, 0], both[:, 1] = key, sums
    kept = np.ones(n, bool)
    for k in (1, 2, 3):
        kept[begins - k] = False
    # pieces that are not the last of their text have no end
    ends = np.array([e for _, _, e in parts])
    kept[(begins + sizes - 1)[~ends]] = False
    return both.view("<u8").reshape(-1)[kept], sizes - ~ends


def _alike(key: np.ndarray) -> np.ndarray:
    """For each key the place of an equal one, the same for most of those that are equal: keys that meet another one in their slot stay
    alone."""
    n = len(key)
    bits = max(1, (n - 1).bit_length())
    table, out = np.empty(1 << bits, np.int32), np.arange(n, dtype=np.int32)
    slot = lambda at: (key[at : at + SLICE] * np.uint64(_MIX) >> np.uint64(64 - bits)).view(np.int64)
    for at in range(0, n, SLICE):
        table[slot(at)] = out[at : at + SLICE]
    for at in range(0, n, SLICE):
        found = table.take(slot(at), mode="clip")
        np.copyto(out[at : at + SLICE], found, where=key.take(found, mode="clip") == key[at : at + SLICE])
    return out


def slots(k: int, form: Shape, context: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Slots of table k for contexts and nodes."""
    if k == 0:
        return (context << np.uint32(NODE_BITS) | node).astype(np.int64)
    # (context + node * first) * second, parted so that each factor is multiplied once for all five bits or all contexts
    return (context * np.uint32(_SECOND) + node * np.uint32(_FIRST * _SECOND & 0xFFFFFFFF) >> np.uint32(32 - form.bits[k - 1])).astype(np.int64)


def node(code: np.ndarray, base: np.ndarray, j: int) -> np.ndarray:
    """The node of bit j of units."""
    return base.astype(np.uint32) + (np.uint32(1 << j) | code.astype(np.uint32) >> np.uint32(5 - j))


def count(counts: np.ndarray, form: Shape, texts: list[bytes]) -> None:
    """Add what follows each slot in the texts to counts[2 * total] (zeros and ones in turn).

    Units of a kind are counted first, so that only their number goes through the five bits and four tables.
    """
    for group in _batches(texts):
        u = units(group, form)
        times = np.bincount(u.kind, minlength=len(u.code)).astype(counts.dtype)
        known = u.contexts
        for j in range(5):
            nodes, bits = node(u.code, u.base, j), u.code >> np.uint8(4 - j) & np.uint8(1)
            for k in range(4):
                at = slots(k, form, known[k], nodes) << 1 | bits
                np.add.at(counts[2 * form.starts[k] : 2 * (form.starts[k] + form.sizes[k])], at, times)


def _batches(texts: list[bytes]) -> Iterator[list[tuple[bytes, bytes, bool]]]:
    held, size = [], 0
    for t in texts:
        for piece in pieces(t):
            held.append(piece)
            size += len(piece[1])
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def predictions(counts: np.ndarray) -> np.ndarray:
    """For each slot, the log odds of a 1 in steps of 1 / SCALE, weighed by the number of cases; 0 where there are none."""
    zero, one = counts[0::2].astype(np.float64), counts[1::2].astype(np.float64)
    odds = np.clip(np.log((one + 0.4) / (zero + 0.4)), -9, 9)
    n = zero + one
    return np.rint(odds * n / (n + 1.0) * SCALE).astype(np.int8)


def predicted(table: np.ndarray, form: Shape, u: Units) -> np.ndarray:
    """[kinds, 32], half a cache line each: what the four tables say of each of the five bits, then the bits, then nothing."""
    out, known = np.empty((len(u.code), 32), np.int8), u.contexts
    for j in range(5):
        nodes = node(u.code, u.base, j)
        for k in range(4):
            out[:, 5 * k + j] = table[form.starts[k] : form.starts[k] + form.sizes[k]].take(slots(k, form, known[k], nodes), mode="clip")
        out[:, 20 + j] = u.code >> np.uint8(4 - j) & np.uint8(1)
    out[u.base > 0, 0:20:5] = SURE
    return out


@dataclass
class State:
    """Weights [5, 4, lanes] and maps [5, lanes, cells]."""

    weights: np.ndarray
    maps: np.ndarray


def start_state(lanes: int) -> State:
    # a cell is the exponent of two of the odds of a 0
    low = (np.arange(MAP_CELLS) - 127 + MAP_CELLS // 2) % MAP_CELLS - MAP_CELLS // 2
    cells = 1 / (1 + 1.5 * 2.0**low)
    return State(np.full((5, 4, lanes), START_WEIGHT, np.float32), np.broadcast_to(cells.astype(np.float32), (5, lanes, MAP_CELLS)))


def code(table: np.ndarray, form: Shape, texts: list[bytes]) -> np.ndarray:
    """Bits that each text costs."""
    bits = np.zeros(len(texts))
    held: list[int] = []
    size = 0

    def flush(some: list[int]) -> None:
        parts = [next(pieces(texts[k])) for k in some]
        u = units(parts, form, KINDS if len(some) > 1 else 1 << 31)
        if u is None:
            flush(some[::2])
            flush(some[1::2])
        else:
            bits[some] = _coded(table, form, u, True, 0, None)[0]

    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        if len(texts[i]) > PIECE:
            done, earlier = 0, None
            for part in pieces(texts[i]):
                cost, done, earlier = _coded(table, form, units([part], form), part[2], done, earlier)
                bits[i] += cost[0]
            continue
        held.append(i)
        size += len(texts[i])
        if size >= GROUP:
            flush(held)
            held, size = [], 0
    if held:
        flush(held)
    return bits


def level_of(block: np.ndarray) -> np.ndarray:
    """0, 1, 2, 2, 3, 3, 3, 3, 4, ...: blocks of a level start from the mean of the states in which those of the level before end."""
    return np.where(block > 0, np.log2(np.maximum(1, block)).astype(np.int64) + 1, 0)


def _coded(table: np.ndarray, form: Shape, u: Units, ends: bool, done: int, earlier: dict[int, tuple[np.ndarray, np.ndarray, int]] | None) -> tuple[np.ndarray, int, dict[int, tuple[np.ndarray, np.ndarray, int]]]:
    """Costs of pieces, their text's number of blocks so far, and by level the sums of the states in which its blocks end.

    ends: whether texts end with the pieces. done, earlier: the last two for the pieces before, if there is one piece.
    """
    known, n_parts = predicted(table, form, u), len(u.sizes)
    n_blocks = np.maximum(1, -(-u.sizes // BLOCK))
    of = np.repeat(np.arange(n_parts), n_blocks)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    begin = np.repeat(np.cumsum(u.sizes) - u.sizes, n_blocks) + nth * BLOCK
    length = np.minimum(BLOCK, u.sizes[of] - nth * BLOCK)
    level = level_of(nth + done)
    last_level = level[np.cumsum(n_blocks) - 1]
    hand_on = not ends
    sums = dict(earlier or {})
    cost = np.zeros(len(of))
    for now in range(int(level.min()), int(level.max()) + 1):
        left, of_end = [], []
        blocks = np.flatnonzero(level == now)
        for some in _dealt(blocks, length):
            state = start_state(len(some))
            if now:
                weights, maps, n = sums[now - 1]
                owner = np.zeros(len(some), np.int64) if earlier is not None else of[some]
                n = n[owner, None, None].astype(np.float32)
                state = State((weights[owner] / n).transpose(1, 2, 0), (maps[owner] / n).transpose(1, 0, 2))
            cost[some] = _run(known, u.kind, int(length[-1]) if hand_on else 0, begin[some], length[some], state)
            left.append(state)
            of_end.append(some)
        order = np.concatenate(of_end)
        # of each text that goes on, the sum of its states
        some = np.argsort(order)
        some = some[(last_level[of[blocks]] > now) | hand_on]
        owner = of[order[some]]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        weights, maps, n = np.zeros((n_parts, 5, 4), np.float32), np.zeros((n_parts, 5, MAP_CELLS), np.float32), np.zeros(n_parts, np.int64)
        if len(first):
            weights[owner[first]] = np.add.reduceat(np.concatenate([x.weights.transpose(2, 0, 1) for x in left])[some], first)
            maps[owner[first]] = np.add.reduceat(np.concatenate([x.maps.transpose(1, 0, 2) for x in left])[some], first)
            n[owner[first]] = np.diff(first, append=len(owner))
        if earlier is not None and now in sums:
            weights, maps, n = weights + sums[now][0], maps + sums[now][1], n + sums[now][2]
        sums[now] = (weights, maps, n)
    return np.bincount(of, cost, n_parts), done + int(n_blocks[-1]), sums


def _dealt(blocks: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
    """Blocks by falling length, LANES at a time."""
    order = blocks[np.argsort(-length[blocks], kind="stable")]
    for k in range(0, len(order), LANES):
        yield order[k : k + LANES]


def _run(known: np.ndarray, kind: np.ndarray, exact: int, begin: np.ndarray, length: np.ndarray, state: State) -> np.ndarray:
    """Costs of blocks of falling length, run from their states, which change in place.

    Blocks of the longest or of the exact length end in their state; that of others is of no use, as their text ends there.

    Weights are held negated and in steps of the inputs, which spares an operation for each.
    """
    n, longest = len(begin), int(length[0])
    whole = state.weights.transpose(1, 0, 2) * np.float32(-1 / SCALE)
    # maps by cells, so that what blocks side by side need lies side by side
    shift = (5 * n - 1).bit_length()
    refined = np.empty((MAP_CELLS, 1 << shift), np.float32)
    refined[:, : 5 * n] = state.maps.reshape(5 * n, MAP_CELLS).T
    refined = refined.reshape(-1)
    # numbers as arrays, which are not made into arrays once more at each step
    one, rate, map_rate, least = (np.array(x, np.float32) for x in (1, RATE / SCALE**2, MAP_RATE, 1e-7))
    exponent, mask = np.array(23 - shift, np.int32), np.array(MAP_CELLS - 1 << shift, np.int32)
    cost, last, w = np.zeros(n), len(kind) - 1, whole.reshape(4, -1)
    m = n
    first_cell = np.arange(5 * n, dtype=np.int32).reshape(5, n)
    own_cell = first_cell.reshape(-1)
    t0 = 0
    while t0 < longest:
        steps = min(STEPS, (exact if t0 < exact else longest) - t0)
        going = int(np.searchsorted(-length, -t0, "left"))
        if going < m:  # blocks that have ended leave the arrays
            whole[:, :, :m] = w.reshape(4, 5, m)
            m = going
            w = np.ascontiguousarray(whole[:, :, :m]).reshape(4, -1)
            own_cell = np.ascontiguousarray(first_cell[:, :m]).reshape(-1)
        nth = np.arange(t0, t0 + steps)[:, None]
        rows = known.take(kind.take(np.minimum(begin[:m] + nth, last)).reshape(-1), axis=0, mode="clip")
        gathered = np.ascontiguousarray(rows[:, :25].T).reshape(25, steps, m)
        gathered, bit = gathered[:20], gathered[20:]
        bit = bit.transpose(1, 0, 2).astype(np.float32, order="C").reshape(steps, -1)
        both = np.empty((steps, 5 * m), np.float32)
        s, part, x, r = np.empty((4, 5 * m), np.float32), np.empty((4, 5 * m), np.float32), np.empty(5 * m, np.float32), np.empty(5 * m, np.float32)
        cell, place = np.empty(5 * m, np.int32), np.empty(5 * m, np.intp)
        inputs, odds, (part0, part1, part2, part3) = s.reshape(20, m), x.view(np.int32), part
        # the five bits of a unit use five sets of weights and five maps: taking them in one step is taking them one by one
        for t in range(steps):
            y = bit[t]
            np.copyto(inputs, gathered[:, t])
            np.multiply(w, s, part)
            np.add(part0, part1, x)
            np.add(x, part2, x)
            np.add(x, part3, x)
            np.exp(x, x)
            # the odds of a 0: their exponent to the base of two names the cell
            np.right_shift(odds, exponent, cell)
            np.bitwise_and(cell, mask, cell)
            np.add(cell, own_cell, cell)
            np.copyto(place, cell)
            np.add(x, one, x)
            np.divide(one, x, x)
            refined.take(place, out=r, mode="clip")
            np.add(x, r, both[t])
            np.subtract(x, y, x)
            np.multiply(x, rate, x)
            np.multiply(s, x, part)
            np.add(w, part, w)
            np.subtract(y, r, x)
            np.multiply(x, map_rate, x)
            np.add(r, x, r)
            refined[place] = r
        both *= np.float32(0.5)
        both += bit
        both -= one
        np.abs(both, out=both)
        np.maximum(both, least, out=both)
        # the logarithm of the product of a unit's five bits, which float32 holds
        both = np.log(both.reshape(steps, 5, m).prod(1))
        if length[m - 1] < t0 + steps:
            both[nth >= length[:m]] = 0  # a block that ends between runs on to no effect
        cost[:m] -= both.sum(0, np.float64)
        t0 += steps
    whole[:, :, :m] = w.reshape(4, 5, m)
    state.weights = whole.transpose(1, 0, 2) * np.float32(-SCALE)
    state.maps = np.ascontiguousarray(refined.reshape(MAP_CELLS, -1)[:, : 5 * n].T).reshape(5, n, MAP_CELLS)
    return cost / np.log(2)
