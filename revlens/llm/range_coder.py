"""A context-mixing range coder for blocks of token ids.

Every block starts from an empty model and is coded on its own. Three predictions of an id are
mixed: how often each id occurs in the block (order 0, a table before the coded ids), the id
that followed the previous one (order 1), and the id that followed the previous two (order 2).
The latter two are kept in hashed slots with a count of how well each has done lately. An id's
probability is the weighted sum of the three. The weights belong to the two counts: in each
such context a weight moves towards its order's share of the probability that the mixture gave
to the id. A block whose ids hardly repeat has no table; all ids are alike in its order 0.

The mixture drives a 48-bit carry-less range coder that puts out 16-bit words. Many blocks are
coded in step, one numpy lane each; a block's bytes do not depend on the others. Probabilities
are whole numbers, and the one quotient of fractions is rounded alike on every machine, so that
blocks can be read on another one. Within a block an id goes by its symbol: the number of
smaller ids in the block, so that a symbol is also where its share of order 0 begins.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
MASK = U((1 << 48) - 1)
TOP, BOTTOM = U(1 << 32), U(1 << 30)
LARGEST_ID = 0xFFFF
ONE, TWO = 1 << 10, 1 << 12  # slots of order 1 and order 2, 4 bytes each, for every lane
SURE = 3  # the largest count of a slot
STATES = (SURE + 1) ** 2
AFTER = np.array([0, 0, 0, 2, 0, 2, 3, 3])  # the count of a slot after a miss, and after a hit; 0: it takes the new symbol
WHOLE, LEAST = 1 << 11, 16  # the weights' sum without order 0, and its weight at least; times 65,536 they are below BOTTOM
FINER = 5  # bits that weights are kept with beyond WHOLE
SLOWNESS = 5  # a weight moves by this power of 1/2 of what it is off


def _start_weights() -> np.ndarray:
    """(2, STATES): orders 1 and 2 begin with more weight the better their slots have done, none if empty."""
    by_count = np.array([0, 1, 3, 6]) * (WHOLE << FINER) // 16
    one, two = np.divmod(np.arange(STATES), SURE + 1)
    return np.stack([np.where(two > 0, by_count[one] // 2, by_count[one]), by_count[two]]).astype(np.int32)


class _Model:
    """The adaptive part: slots of both orders and their weights, for each lane of ``sizes[lane]`` shares.

    Arrays of two rows hold order 1 and order 2. Lanes that are coded at a time are the first ones.
    """

    def __init__(self, sizes: np.ndarray):
        lanes = len(sizes)
        self.sizes = sizes
        self.totals = sizes * (WHOLE + LEAST)
        self.slots = np.zeros(lanes * (ONE + TWO), np.int32)
        self.weights = np.tile(_start_weights()[:, None], (1, lanes, 1)).reshape(-1)
        self.base = np.stack([np.arange(lanes) * ONE, lanes * ONE + np.arange(lanes) * TWO])
        self.context = np.arange(lanes) * STATES + np.array([[0], [lanes * STATES]])
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self, n: int) -> None:
        """Begin an id in the first ``n`` lanes."""
        self.n, one = n, self.last[:n]
        self.at = self.base[:, :n].copy()
        self.at[0] += one * 2654435761 >> 9 & (ONE - 1)
        self.at[1] += (one * 40503 + self.before[:n] + 1) * 2654435761 >> 11 & (TWO - 1)
        held = self.slots.take(self.at).astype(np.int64)
        self.held, self.sure = held >> 2, held & SURE
        self.mixer = self.context[:, :n] + (self.sure[0] * (SURE + 1) + self.sure[1])
        self.fine = self.weights.take(self.mixer).astype(np.int64)
        weights = self.fine >> FINER
        self.rest = (WHOLE + LEAST) - weights[0] - weights[1]  # the weight of order 0, for each of the block's shares
        self.bumps = weights * self.sizes[:n]
        self.total = self.totals[:n]

    def interval(self, symbol: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, width) of a symbol that has ``count`` shares of order 0."""
        self.hit = self.held == symbol
        self.own = self.bumps * self.hit
        below = self.bumps * (self.held < symbol)
        self.width = self.rest * count + self.own[0] + self.own[1]
        return self.rest * symbol + below[0] + below[1], self.width

    def share_at(self, place: np.ndarray, counts_of) -> np.ndarray:
        """Which of the block's shares of order 0 belongs to the symbol whose interval holds ``place``."""
        ends = self.rest * (self.held + counts_of(self.held))
        swapped = self.held[0] > self.held[1]
        first, second = np.where(swapped, ends[::-1], ends), np.where(swapped, self.bumps[::-1], self.bumps)
        for end, bump in zip(first, second):
            place = np.where(place < end, place, np.maximum(place - bump, end - 1))
        return place // self.rest

    def learn(self, symbol: np.ndarray) -> None:
        """The symbol that the last interval was of."""
        given = (self.own / self.width * (WHOLE << FINER)).astype(np.int64)
        given -= self.fine
        given >>= SLOWNESS
        given += self.fine
        self.weights[self.mixer] = given
        after = AFTER.take(self.sure + self.hit * (SURE + 1))
        self.slots[self.at] = np.where(after, self.held * 4 + after, symbol * 4 + 1)
        self.before[: self.n] = self.last[: self.n]
        self.last[: self.n] = symbol


class _Coder:
    """The interval of each lane, and the moves of its leading words in and out."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, U)
        self.range = np.full(lanes, MASK, U)
        self.size = np.zeros(lanes, np.int64)

    def narrow(self, unit: np.ndarray, start: np.ndarray, width: np.ndarray) -> None:
        """To a part of the first lanes, of ``unit`` each."""
        n = len(unit)
        low, span = self.low[:n], self.range[:n]
        low += unit * start.view(U)
        np.multiply(unit, width.view(U), out=span)
        small = np.flatnonzero(span < TOP)
        while len(small):
            near, left = low[small], span[small]
            crossing = ((near ^ (near + left)) >= TOP) | (near + left > MASK)
            move = ~crossing | (left < BOTTOM)
            if not move.all():
                small, near, left, crossing = small[move], near[move], left[move], crossing[move]
                if not len(small):
                    break
            left = np.where(crossing, (~near + U(1)) & (BOTTOM - U(1)), left)
            self.shift(small, near)
            low[small] = (near << U(16)) & MASK
            left <<= U(16)
            span[small] = left
            small = small[left < TOP]


class _Encoder(_Coder):
    def __init__(self, lanes: int, longest: int):
        super().__init__(lanes)
        self.out = np.zeros((lanes, longest + longest // 2 + 64), np.uint16)

    def shift(self, lane: np.ndarray, low: np.ndarray) -> None:
        at = self.size.take(lane)
        if at.max() + 4 > self.out.shape[1]:
            self.out = np.concatenate([self.out, np.zeros_like(self.out)], axis=1)
        self.out[lane, at] = low >> U(32)
        self.size[lane] = at + 1

    def put(self, start: np.ndarray, width: np.ndarray, total: np.ndarray) -> None:
        self.narrow(self.range[: len(total)] // total.view(U), start, width)

    def finish(self) -> list[bytes]:
        for shift in (32, 16, 0):
            self.out[np.arange(len(self.low)), self.size] = ((self.low >> U(shift)) & U(0xFFFF)).astype(np.uint16)
            self.size += 1
        return [row[:n].astype("<u2").tobytes() for row, n in zip(self.out, self.size.tolist())]


class _Decoder(_Coder):
    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads))
        self.words = np.zeros((len(payloads), max(len(p) for p in payloads) // 2 + 4), np.uint16)
        for row, payload in zip(self.words, payloads):
            row[: len(payload) // 2] = np.frombuffer(payload, "<u2")
        self.code = np.zeros(len(payloads), U)
        for k in range(3):
            self.code = (self.code << U(16)) | self.words[:, k].astype(U)
        self.size += 3

    def shift(self, lane: np.ndarray, low: np.ndarray) -> None:
        at = self.size.take(lane)
        word = self.words[lane, np.minimum(at, self.words.shape[1] - 1)]
        self.code[lane] = ((self.code.take(lane) << U(16)) & MASK) | word
        self.size[lane] = at + 1

    def place(self, total: np.ndarray) -> np.ndarray:
        """Where in ``total`` the next symbol's interval lies."""
        n = len(total)
        self.unit = self.range[:n] // total.view(U)
        gap = ((self.code[:n] - self.low[:n]) & MASK) // self.unit
        return np.minimum(gap.view(np.int64), total - 1)

    def take(self, start: np.ndarray, width: np.ndarray) -> None:
        self.narrow(self.unit, start, width)


def _steps(values: np.ndarray, limit: int) -> bytes:
    """Ascending numbers below ``limit``: low bits as they are, high ones as gaps of ones and zeros."""
    low = _low_bits(len(values), limit)
    high = (values >> low) + np.arange(len(values))
    bits = np.zeros((limit >> low) + len(values) + 1, np.uint8)
    bits[high] = 1
    lows = (values[:, None] >> np.arange(low)) & 1
    return np.packbits(np.append(bits, lows.ravel().astype(np.uint8))).tobytes()


def _low_bits(n: int, limit: int) -> int:
    return max(0, (limit // n).bit_length() - 1)


def _from_steps(data: np.ndarray, n: int, limit: int) -> tuple[np.ndarray, int]:
    """(the n numbers of ``_steps``, how many bytes they take)."""
    low = _low_bits(n, limit)
    size = (limit >> low) + n + 1
    used = -(-(size + n * low) // 8)
    bits = np.unpackbits(data[:used])
    high = np.flatnonzero(bits[:size]) - np.arange(n)
    lows = bits[size : size + n * low].reshape(n, low).astype(np.int64) @ (1 << np.arange(low))
    return (high << low) + lows, used


def _table(block: np.ndarray) -> bytes:
    """The distinct ids and how often each occurs, after their number; no ids if they hardly repeat."""
    ids, counts = np.unique(block, return_counts=True)
    if 2 * len(ids) > len(block) or len(block) > LARGEST_ID:
        return b"\0\0"
    return len(ids).to_bytes(2, "little") + _steps(ids.astype(np.int64), LARGEST_ID + 1) + _steps(np.cumsum(counts) - 1, len(block))


def _read_table(payload: bytes, size: int) -> tuple[np.ndarray | None, int]:
    """(the sorted ids of a block, None without a table; how many bytes the table takes)."""
    n = int.from_bytes(payload[:2], "little")
    if not n:
        return None, 2
    data = np.frombuffer(payload, np.uint8, offset=2)
    ids, used = _from_steps(data, n, LARGEST_ID + 1)
    ends, more = _from_steps(data[used:], n, size)
    return np.repeat(ids, np.diff(ends + 1, prepend=0)), 2 + used + more


def _shares(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) for each place of sorted ids: where its id begins, and how often it occurs."""
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    counts = np.diff(np.append(first, len(ordered)))
    return np.repeat(first, counts), np.repeat(counts, counts)


def _lanes_at(step: int, sizes: np.ndarray) -> int:
    """How many blocks, from the longest to the shortest, are longer than ``step``."""
    return len(sizes) if step < sizes[-1] else int(np.searchsorted(-sizes, -step, "left"))


def _encode(blocks: list[np.ndarray], plain: bool) -> list[bytes]:
    """Blocks from the longest to the shortest, all with tables or all without (``plain``)."""
    sizes = np.array([len(b) for b in blocks])
    lanes, longest = len(blocks), int(sizes[0])
    symbols = np.zeros((longest, lanes), np.uint16)
    counts = np.ones((longest, lanes), np.uint16)
    for k, block in enumerate(blocks):
        if plain:
            symbols[: len(block), k] = block
        else:
            order = np.argsort(block.astype(np.uint16), kind="stable")
            symbols[order, k], counts[order, k] = _shares(block[order])
    model, coder = _Model(np.full(lanes, LARGEST_ID + 1) if plain else sizes), _Encoder(lanes, longest)
    for step in range(longest):
        n = _lanes_at(step, sizes)
        now = symbols[step, :n].astype(np.int64)
        model.predict(n)
        coder.put(*model.interval(now, counts[step, :n]), model.total)
        model.learn(now)
    return coder.finish()


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The payload of each block of ids; an id over ``LARGEST_ID`` is refused."""
    held = [b for b in blocks if len(b)]
    if held:
        least, most = min(int(b.min()) for b in held), max(int(b.max()) for b in held)
        if least < 0 or most > LARGEST_ID:
            raise ValueError(f"ids are from 0 to {LARGEST_ID}, not {least} to {most}")
    out = [_table(b) if len(b) else b"" for b in blocks]
    for plain in (False, True):
        mine = [k for k, table in enumerate(out) if table and (table == b"\0\0") == plain]
        mine.sort(key=lambda k: -len(blocks[k]))
        for k, coded in zip(mine, _encode([blocks[k] for k in mine], plain) if mine else []):
            out[k] += coded
    return out


def _decode(payloads: list[bytes], sizes: np.ndarray, tables: list[np.ndarray] | None) -> list[np.ndarray]:
    """The ids of blocks from the longest to the shortest, all with sorted ids as tables or all without."""
    lanes, longest = len(payloads), int(sizes[0])
    model, coder = _Model(np.full(lanes, LARGEST_ID + 1) if tables is None else sizes), _Decoder(payloads)
    ids = np.zeros((longest, lanes), np.uint16)
    if tables is not None:
        known = np.zeros(lanes * longest, np.int64)  # 16 bits each: the id, where it begins, how often it occurs
        for k, ordered in enumerate(tables):
            first, count = _shares(ordered)
            known[k * longest : k * longest + len(ordered)] = ordered | first << 16 | count << 32
    begins = np.arange(lanes) * longest
    for step in range(longest):
        n = _lanes_at(step, sizes)
        begin = begins[:n]
        count_of = (lambda symbol: 1) if tables is None else (lambda symbol: known.take(begin + symbol) >> 32)  # noqa: B023
        model.predict(n)
        symbol = model.share_at(coder.place(model.total), count_of)
        if tables is None:
            ids[step, :n], count = symbol, 1
        else:
            found = known.take(begin + symbol)
            ids[step, :n], symbol, count = found & LARGEST_ID, found >> 16 & LARGEST_ID, found >> 32
        coder.take(*model.interval(symbol, count))
        model.learn(symbol)
    return [ids[:n, k].astype(np.int64) for k, n in enumerate(sizes.tolist())]


def decode_blocks(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, from its payload and its number of ids."""
    out = [np.zeros(0, np.int64)] * len(payloads)
    tables = [_read_table(p, n) if n else (None, 0) for p, n in zip(payloads, sizes)]
    for plain in (False, True):
        mine = [k for k, n in enumerate(sizes) if n and (tables[k][0] is None) == plain]
        mine.sort(key=lambda k: -sizes[k])
        if mine:
            coded = [payloads[k][tables[k][1] :] for k in mine]
            found = _decode(coded, np.array([sizes[k] for k in mine]), None if plain else [tables[k][0] for k in mine])
            for k, ids in zip(mine, found):
                out[k] = ids
    return out
