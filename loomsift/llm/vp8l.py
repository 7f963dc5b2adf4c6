"""Decoding of lossless WebP (VP8L) streams.

The decoder reads prefix codes (simple and normal), meta prefix groups, back-references, the colour cache, and the
predictor, cross-colour, subtract-green and palette transforms. A pixel that is a literal takes as many bits as its four
codes say, so for a stretch of the stream the pixel and the next place are found for every bit at once with whole-array
steps; reading then hops from pixel to pixel, and stops where a back-reference stands. Many images are read side by side where they can be: each
step of whole arrays reads one symbol of a code's lengths, or one pixel, of every image, until few images are left.
Pixels are arrays of shape (height, width, 4), channels red, green, blue, alpha.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Generator, Iterator, Sequence

import numpy as np

# Fixed values of the format.
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3),
    (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4),
    (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0), (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2),
    (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7),
    (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS, GREEN, PALETTE = range(4)
CACHE_HASH = 0x1E35A7BD
SIDE = 1 << 14


class Bits:
    """A reader of little-endian bit order."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0
        self.said: tuple[int, int, int, Code] | None = None  # the last code's alphabet, description, its size, and the code

    def many(self, at: int, n: int) -> int:
        """So many bits from a place on."""
        return (int.from_bytes(self.data[at >> 3 : (at + n + 7) >> 3], "little") >> (at & 7)) & ((1 << n) - 1)

    def peek(self, n: int) -> int:
        k = self.at >> 3
        return (int.from_bytes(self.data[k : k + 4], "little") >> (self.at & 7)) & ((1 << n) - 1)

    def read(self, n: int) -> int:
        x = self.peek(n)
        self.at += n
        if self.at > 8 * len(self.data):
            raise ValueError("the stream ends early")
        return x


@functools.lru_cache(maxsize=16)
def turned(n: int) -> np.ndarray:
    """The numbers of n bits with their bits in reverse order."""
    return reversed_bits(np.arange(1 << n), n)


class Code:
    """A canonical prefix code given the lengths of its symbols: symbol and length for each value of the next bits.

    table: the symbol, and in the low four bits the length.
    """

    def __init__(self, used: np.ndarray, size: np.ndarray) -> None:
        """Of symbols and their lengths in order of lengths, then of symbols."""
        self.bits, self.only = 0, int(used[0]) if len(used) else 0
        if len(used) < 2:
            self.table = np.array([self.only << 4])
            return
        self.bits = int(size[-1])
        # codes in canonical order fill the longest one's range
        span = 1 << (self.bits - size)
        if int(span.sum()) != 1 << self.bits:
            raise ValueError("a prefix code is not complete")
        self.table = (used << 4 | size).repeat(span).take(turned(self.bits))

    def read(self, r: Bits) -> int:
        x = int(self.table[r.peek(self.bits)])
        r.at += x & 15
        return x >> 4

    def entries(self, values: np.ndarray) -> np.ndarray:
        """The table's entries where these are the next bits."""
        return self.table.take(values & ((1 << self.bits) - 1), mode="clip")  # clipping is the fastest way of numpy's

    def look(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and lengths where these are the next bits."""
        x = self.entries(values)
        return x >> 4, x & 15


def reversed_bits(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(x)
    for i in range(n):
        out |= ((x >> i) & 1) << (n - 1 - i)
    return out


def read_code(r: Bits, alphabet: int) -> Code:
    return read_codes([(r, alphabet)])[0]


def read_codes(asked: Sequence[tuple[Bits, int]]) -> list[Code]:
    """A code of so many symbols from each reader. A description tells where it ends, so the bits of the one before say the same code."""
    out: list[Code | None] = [None] * len(asked)
    normal = []
    for k, (r, alphabet) in enumerate(asked):
        if r.said and r.said[0] == alphabet and r.at + r.said[2] <= 8 * len(r.data) and r.many(r.at, r.said[2]) == r.said[1]:
            r.at += r.said[2]
            out[k] = r.said[3]
        elif r.read(1):
            two, wide = r.read(1), r.read(1)
            symbols = {r.read(8 if wide else 1), *((r.read(8),) if two else ())}
            out[k] = Code(np.array(sorted(symbols)), np.ones(len(symbols), np.int64))
        else:
            normal.append(k)
    first = [asked[k][0].at - 1 for k in normal]
    for k, at, code in zip(normal, first, described_codes([asked[k] for k in normal]) if normal else (), strict=True):
        r, alphabet = asked[k]
        r.said = alphabet, r.many(at, r.at - at), r.at - at, code
        out[k] = code
    return out


#: Of symbols of code lengths: the number of their extra bits, and how many lengths they say at least.
MORE, LEAST = np.array([0] * 16 + [2, 3, 7]), np.array([1] * 16 + [3, 3, 11])
ORDER = np.array(LENGTH_ORDER)


def described_codes(asked: Sequence[tuple[Bits, int]]) -> list[Code]:
    """Codes given by runs of lengths under a code of their own, one run of each at a time."""
    many = len(asked)
    kinds = np.zeros((many, 19), np.int64)
    left, alphabets, parts, begins, n = [], np.array([a for _, a in asked]), [], [], 0
    for k, (r, alphabet) in enumerate(asked):
        some = 4 + r.read(4)
        bits = r.many(r.at, 3 * some)
        kinds[k, ORDER[:some]] = [bits >> 3 * j & 7 for j in range(some)]
        r.at += 3 * some
        left.append(2 + r.read(2 + 2 * r.read(3)) if r.read(1) else alphabet)
        parts.append(r.data[r.at >> 3 : (r.at >> 3) + 2 * alphabet])  # a run takes 14 bits at most
        begins.append(8 * n + (r.at & 7))
        n += len(parts[-1])
    raw = np.frombuffer(b"".join([*parts, bytes(4)]), np.uint8).astype(np.int64)
    raw = raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16
    # the runs' codes fill seven bits
    row, symbol = kinds.nonzero()
    key = row << 8 | kinds[row, symbol] << 5 | symbol
    key.sort()
    row, size, symbol = key >> 8, key >> 5 & 7, key & 31
    size[np.bincount(row, minlength=many).take(row) == 1] = 0
    span = 128 >> size
    if (np.bincount(row, span, many) != 128).any():
        raise ValueError("a prefix code is not complete")
    table = (symbol << 4 | size).repeat(span).reshape(many, 128)[:, turned(7)].ravel()
    least, more = LEAST.take(table >> 4), MORE.take(table >> 4)
    mask, step = (1 << more) - 1, (table & 15) + more
    lengths_of, place, said, limit, base = np.arange(many), np.array(begins), np.zeros(many, np.int64), alphabets.copy(), np.arange(many) << 7
    left, ended, found = np.array(left), np.zeros(many, np.int64), []
    last, turns = len(raw) - 1, 0
    while len(place):
        bits = raw.take(np.minimum(place >> 3, last)) >> (place & 7)
        here = base + (bits & 127)
        number = least.take(here) + (bits >> (table.take(here) & 15) & mask.take(here))
        found.append((lengths_of, table.take(here) >> 4, number))
        place = place + step.take(here)
        said = said + number
        turns += 1
        going = (said < limit) & (left > turns)
        if not going.all():
            ended[lengths_of] = place
            lengths_of, place, said, limit, base, left = (x[going] for x in (lengths_of, place, said, limit, base, left))
    of, symbol, number = (np.concatenate(x) for x in zip(*found, strict=True))
    order = of.astype(np.int16).argsort(kind="stable") if many < 1 << 15 else of.argsort(kind="stable")
    of, symbol, number = of[order], symbol[order], number[order]
    for (r, _), at in zip(asked, (ended - begins).tolist(), strict=True):
        r.at += at
        if r.at > 8 * len(r.data):
            raise ValueError("the stream ends early")
    whole = np.bincount(of, number, many).astype(np.int64)
    if (whole > alphabets).any():
        raise ValueError("code lengths run over the alphabet")
    # 16 repeats the code's last length that isn't 0, or 8
    kept = np.maximum.accumulate(np.where((symbol > 0) & (symbol < 16), np.arange(len(symbol)), -1))
    before = np.where((kept >= 0) & (of[kept] == of), symbol[kept], 8)
    value = np.where(symbol < 16, symbol, np.where(symbol == 16, before, 0)).repeat(number)
    of = of.repeat(number)
    symbol = np.arange(len(of)) - (whole.cumsum() - whole).take(of)
    some = value.nonzero()[0]
    key = of[some] << 20 | value[some] << 16 | symbol[some]
    key.sort()
    ends = np.bincount(key >> 20, minlength=many).cumsum().tolist()
    used, size = key & 0xFFFF, key >> 16 & 15
    return [Code(used[a:z], size[a:z]) for a, z in zip([0, *ends], ends, strict=False)]


def read_value(r: Bits, prefix: int) -> int:
    """A length or distance from its prefix symbol."""
    if prefix < 4:
        return prefix + 1
    extra = (prefix - 2) >> 1
    return ((2 + (prefix & 1)) << extra) + r.read(extra) + 1


#: Fewest images that are read side by side, most of them, and most of their pixels.
FEW, IMAGES, PIXELS = 96, 1024, 1 << 21
NEAR_X, NEAR_Y = np.array([(0, 0), *NEAR]).T


def values_of(prefix: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`read_value` where these are the next bits, and the number of those that are read."""
    extra = np.maximum(prefix - 2, 0) >> 1
    return np.where(prefix < 4, prefix, (2 + (prefix & 1) << extra) + (bits & (1 << extra) - 1)) + 1, extra


class Begun:
    """What has been read of an image's pixels.

    literals: what its literals and entries are; copies: how many of them came before, length, and distance.
    """

    def __init__(self) -> None:
        self.n, self.literals, self.copies = 0, np.empty(0, np.int64), []


def begin_pixels(asked: Sequence[tuple[Bits, list[Code], int, int]]) -> list[Begun]:
    """Read images of one group of codes (with widths and numbers of pixels) side by side, a pixel of each at a time, until few are left."""
    out = [Begun() for _ in asked]
    # a step looks at 56 bits; alpha's code mostly has one symbol
    fit = [k for k, (_, c, _, _) in enumerate(asked) if not c[3].bits and c[0].bits + c[1].bits + c[2].bits <= 56 and c[0].bits + c[4].bits <= 28]
    if len(fit) < FEW:
        return out
    readers = [asked[k][0] for k in fit]
    codes = [asked[k][1] for k in fit]
    tables, at, n = [], [], 0
    for c in codes:
        places = []
        for j in (0, 1, 2, 4):
            if j == 2 and c[2] is c[1]:
                places.append(places[1])
                continue
            places.append(n)
            tables.append(c[j].table)
            n += len(c[j].table)
        at.append(places)
    table = np.concatenate(tables)
    green_at, red_at, blue_at, dist_at = np.array(at).T.copy()
    green_mask, red_mask, blue_mask, dist_mask = ((1 << np.array([c[j].bits for c in codes])) - 1 for j in (0, 1, 2, 4))
    alpha = np.array([c[3].only << 24 for c in codes])
    width, total = (np.array([asked[k][j] for k in fit]) for j in (2, 3))
    # 64 bits from each byte on; a step takes 7 bytes at most, and places are looked at each 64 steps
    held = b"".join([*(r.data for r in readers), bytes(512)])
    words = np.ndarray(len(held) - 7, "<i8", held, strides=(1,))
    sizes = np.array([8 * len(r.data) for r in readers])
    begins = sizes.cumsum() - sizes
    place, end = begins + [r.at for r in readers], begins + sizes
    starts = total.cumsum() - total
    made = np.empty(int(total.sum()), np.int64)
    ids, to, n, turns = np.arange(len(fit)), starts.copy(), np.zeros(len(fit), np.int64), 0
    ended, wrote, pixels = place.copy(), to.copy(), n.copy()
    while True:
        bits = words[place >> 3] >> (place & 7)
        entry = table.take(green_at + (bits & green_mask))
        size, green = entry & 15, entry >> 4
        bits >>= size
        red = table.take(red_at + (bits & red_mask))
        more = red & 15
        blue = table.take(blue_at + (bits >> more & blue_mask))
        more += blue & 15
        other = (green > 255).nonzero()[0]
        red >>= 4
        red <<= 16
        red |= green << 8
        red |= blue >> 4
        red |= alpha
        if len(other):
            symbol = green[other]
            red[other], more[other] = 279 - symbol, 0
            made[to] = red
            copy = other[symbol < 280]
            if len(copy):
                length, extra = values_of(green[copy] - 256, bits[copy])
                rest = bits[copy] >> extra
                entry = table.take(dist_at[copy] + (rest & dist_mask[copy]))
                distance, far = values_of(entry >> 4, rest >> (entry & 15))
                more[copy] = extra + (entry & 15) + far
                near = np.minimum(distance, 120)
                distance = np.where(distance > 120, distance - 120, np.maximum(1, NEAR_X[near] + NEAR_Y[near] * width[copy]))
                if (distance > n[copy]).any() or (n[copy] + length > total[copy]).any():
                    raise ValueError("a back-reference leaves the image")
                for k, before, m, d in zip(ids[copy].tolist(), (to - starts)[copy].tolist(), length.tolist(), distance.tolist(), strict=True):
                    out[fit[k]].copies.append((before, m, d))
                n[copy] += length - 1
                to[copy] -= 1
        else:
            made[to] = red
        place += size
        place += more
        n += 1
        to += 1
        turns += 1
        going = n < total
        if not turns % 64 and (place > end).any():
            raise ValueError("the stream ends early")
        if not going.all():
            ended[ids], wrote[ids], pixels[ids] = place, to, n
            if (place > end).any():
                raise ValueError("the stream ends early")
            if np.count_nonzero(going) < FEW:
                break
            ids, to, n, place, end, starts, total, width, alpha, green_at, red_at, blue_at, dist_at, green_mask, red_mask, blue_mask, dist_mask = (
                x[going] for x in (ids, to, n, place, end, starts, total, width, alpha, green_at, red_at, blue_at, dist_at, green_mask, red_mask, blue_mask, dist_mask)
            )
    first = 0
    for k, r, at, z, m in zip(fit, readers, (ended - begins).tolist(), wrote.tolist(), pixels.tolist(), strict=True):
        r.at, out[k].n, out[k].literals = at, m, made[first:z]
        first += asked[k][3]
    return out


#: Bits of a stream that are looked at together, and the most that a literal can take.
STRETCH, LITERAL = 1 << 15, 60
EIGHT = np.arange(8)


class Stretch:
    """For each bit of a stretch, where the pixel after the one that begins there begins.

    next is -1 at a back-reference and -2 past the stretch. A literal's four codes stand one after the other.
    """

    def __init__(self, r: Bits, codes: list[list[Code]]) -> None:
        self.codes, self.begin = codes, r.at >> 3 << 3
        raw = np.frombuffer(r.data[self.begin >> 3 : (self.begin + STRETCH + 2 * LITERAL + 24) >> 3].ljust(3, b"\0") + b"\0\0", np.uint8).astype(np.int64)
        self.values = values = ((raw[:-2] | raw[1:-1] << 8 | raw[2:] << 16)[:, None] >> EIGHT).ravel()
        here = np.arange(len(values))
        self.end = self.begin + min(STRETCH, len(values))
        self.next = []
        for green, red, blue, alpha, _ in codes:
            index = values & ((1 << green.bits) - 1)
            first = (green.table & 15).take(index, mode="clip")
            first += here
            other = (green.table >= 256 << 4).take(index, mode="clip").nonzero()[0]
            place, sizes = first, None
            for code, same in ((red, None), (blue, red), (alpha, None)):
                if code.bits:
                    if code is not same:
                        sizes = (code.table & 15).take(values & ((1 << code.bits) - 1), mode="clip")
                    place = place + sizes.take(place, mode="clip")
            hop = np.full(len(place) + 4 * LITERAL, -2)
            hop[: self.end - self.begin] = place[: self.end - self.begin]
            other = other[: other.searchsorted(self.end - self.begin)]
            hop[other] = np.where(green.table.take(index[other]) >= 280 << 4, first[other], -1)
            self.next.append(memoryview(hop))

    def pixels(self, places: np.ndarray, group: int = 0) -> np.ndarray:
        """What begins at these bits: a literal's argb, or -1 - k for entry k of the colour cache."""
        green, *others, _ = self.codes[group]
        g = green.entries(self.values[places])
        place, argb = places + (g & 15), g >> 4 << 8
        for code, shift in zip(others, (16, 0, 24), strict=True):
            if code.bits:
                x = code.entries(self.values.take(place, mode="clip"))
                place, argb = place + (x & 15), argb | x >> 4 << shift
            else:
                argb |= code.only << shift
        return np.where(g < 256 << 4, argb, 279 - (g >> 4))


class Cache:
    """The colour cache, brought up to date with the pixels read only when entries are asked for."""

    def __init__(self, bits: int) -> None:
        self.shift, self.held, self.at = 32 - bits, np.zeros(1 << bits, np.int64), 0

    def place(self, p: np.ndarray) -> np.ndarray:
        return ((CACHE_HASH * p) & 0xFFFFFFFF) >> self.shift

    def resolve(self, argb: np.ndarray, first: int, n: int) -> None:
        """Replace the entries' numbers in argb[first:n] by their pixels.

        An entry holds the last pixel that belongs in its place, and is put back there when it is read. So in order of
        places and time, an entry is the pixel before it.
        """
        before = argb[self.at : first]
        if len(before):
            self.held[self.place(before)] = before  # of equal places the last one stays
        p = argb[first:n]
        place = np.where(p < 0, -1 - p, self.place(p))
        order = place.astype(np.int16).argsort(kind="stable")
        placed, sorted_, at = place[order], p[order], np.arange(n - first)
        own = sorted_ >= 0
        known = own.copy()
        known[0] = True
        known[1:] |= placed[1:] != placed[:-1]
        source = np.maximum.accumulate(np.where(known, at, 0))
        value = np.where(own[source], sorted_[source], self.held[placed])
        if (placed[value == 0] != 0).any():  # an entry that was never written: 0, which belongs in another place
            for k in range(first, n):
                argb[k] = argb[k] if argb[k] >= 0 else self.held[-1 - argb[k]]
                self.held[self.place(argb[k : k + 1])] = argb[k]
            self.at = n
            return
        p[order] = value
        self.at = first  # they are held when entries are asked for again


def copied(argb: np.ndarray, n: int, length: int, distance: int) -> None:
    """Write so many pixels from n on, each the one ``distance`` before; they may overlap what they copy."""
    while length:
        k = min(length, distance)
        argb[n : n + k] = argb[n - distance : n - distance + k]
        n, length, distance = n + k, length - k, distance + k


def laid_out(literals: np.ndarray, copies: list[tuple[int, int, int]], total: int, cache: Cache | None) -> np.ndarray:
    """Pixels from literals, entries of the cache, and copies of what came before."""
    argb = np.empty(total, np.int64)
    entries = (literals < 0).nonzero()[0] if cache is not None else literals[:0]
    n = last = known = 0
    # entries up to each copy
    until = entries.searchsorted([k for k, _, _ in copies] + [len(literals)]).tolist()
    for (k, length, distance), entry in zip((*copies, (len(literals), 0, 0)), until, strict=True):
        first, n = n, n + k - last
        argb[first:n] = literals[last:k]
        if entry > known:
            cache.resolve(argb, first, n)
        copied(argb, n, length, distance)
        n, last, known = n + length, k, entry
    return argb


#: What reads many images' codes, or pixels, is asked for by each of them, with what it takes.
Asked = tuple[Callable[[list], list], tuple]


def read_pixels(r: Bits, width: int, height: int, main: bool) -> Generator[Asked, object, np.ndarray]:
    """An entropy-coded image; main: it may have meta prefix groups."""
    cache_bits = r.read(4) if r.read(1) else 0
    if cache_bits > 11:
        raise ValueError("the colour cache is too large")
    which, shift, groups, across = None, 0, 1, 0
    if main and r.read(1):
        shift = r.read(3) + 2
        meta = yield from read_pixels(r, (width + (1 << shift) - 1) >> shift, (height + (1 << shift) - 1) >> shift, False)
        across, which = meta.shape[1], (meta[..., 0].astype(np.int64) << 8 | meta[..., 1]).ravel().tolist()
        groups = max(which) + 1
    size = 280 + (1 << cache_bits if cache_bits else 0)
    codes = []
    for _ in range(groups):
        codes.append([])
        for n in (size, 256, 256, 256, 40):
            codes[-1].append((yield read_codes, (r, n)))
    total, ends = width * height, 8 * len(r.data)
    begun = (yield begin_pixels, (r, codes[0], width, total)) if which is None else Begun()
    n, g, literals, copies = begun.n, 0, [begun.literals], begun.copies
    had = len(begun.literals)
    while n < total:
        # pixels up to the stretch's end
        some = Stretch(r, codes)
        places, of_group = [], []
        at, hop, add, limit = r.at - some.begin, some.next[0], places.append, some.end - some.begin
        while n < total and at < limit:
            first = len(places)
            if which is None:
                for _ in range(total - n):
                    after = hop[at]
                    if after < 0:
                        break
                    add(at)
                    at = after
                n += len(places) - first
            else:
                while n < total:
                    g = which[((n // width) >> shift) * across + ((n % width) >> shift)]
                    after = some.next[g][at]
                    if after < 0:
                        break
                    of_group.append(g)
                    add(at)
                    at = after
                    n += 1
            if n == total or at >= limit:
                break
            r.at = some.begin + at
            green, _, _, _, dist = codes[g]
            length = read_value(r, green.read(r) - 256)
            d = read_value(r, dist.read(r))
            if d > 120:
                d -= 120
            else:
                x, y = NEAR[d - 1]
                d = max(1, x + y * width)
            if d > n or n + length > total:
                raise ValueError("a back-reference leaves the image")
            copies.append((had + len(places), length, d))
            n += length
            at = r.at - some.begin
        r.at = some.begin + at
        if r.at > ends:
            raise ValueError("the stream ends early")
        had += len(places)
        if places and which is None:
            literals.append(some.pixels(np.array(places)))
        elif places:
            at_bits, in_group, found = np.array(places), np.array(of_group), np.empty(len(places), np.int64)
            for k in np.unique(in_group).tolist():
                found[in_group == k] = some.pixels(at_bits[in_group == k], k)
            literals.append(found)
    argb = laid_out(np.concatenate(literals), copies, total, Cache(cache_bits) if cache_bits else None)
    # red and blue change places
    turned_ = (argb & 0xFF00FF00) | (argb >> 16 & 0xFF) | (argb & 0xFF) << 16
    return turned_.astype("<u4").view(np.uint8).reshape(height, width, 4)


def _average(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a + b) >> 1


def predicted(mode: int, left: np.ndarray, top: np.ndarray, top_left: np.ndarray, top_right: np.ndarray) -> np.ndarray:
    """The prediction of a pixel (int arrays of four channels) by one of the 14 modes."""
    if mode == 0 or mode > 13:
        return np.array([0, 0, 0, 255])
    if mode < 5:
        return (left, top, top_right, top_left)[mode - 1]
    if mode == 5:
        return _average(_average(left, top_right), top)
    if mode < 10:
        return _average(*((left, top_left), (left, top), (top_left, top), (top, top_right))[mode - 6])
    if mode == 10:
        return _average(_average(left, top_left), _average(top, top_right))
    if mode == 11:
        return left if np.abs(top - top_left).sum() < np.abs(left - top_left).sum() else top
    if mode == 12:
        return np.clip(left + top - top_left, 0, 255)
    mean = _average(left, top)
    half = (np.abs(mean - top_left) >> 1) * np.sign(mean - top_left)
    return np.clip(mean + half, 0, 255)


def neighbours(p: np.ndarray, y: int, x: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Left, top, top-left and top-right of an inner pixel; at the right edge the row's own first is top-right."""
    return p[y, x - 1], p[y - 1, x], p[y - 1, x - 1], p[y - 1, x + 1] if x + 1 < p.shape[1] else p[y, 0]


def invert_predictor(p: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    height, width, _ = p.shape
    used = set((modes[..., 1] & 15).ravel().tolist())
    if used in ({1}, {2}):  # sums of a row from its first pixel, or of a column, all at once, of bytes that wrap
        out = p.copy()
        out[0, 0, 3] = (int(out[0, 0, 3]) + 255) & 255
        out[0].cumsum(0, np.uint8, out[0])
        if used == {1}:
            out[:, 0].cumsum(0, np.uint8, out[:, 0])
            out[1:] = out[1:].cumsum(1, np.uint8)
            return out
        return out.cumsum(0, np.uint8)
    out = p.astype(np.int64)
    out[0, 0] = (out[0, 0] + (0, 0, 0, 255)) & 255
    out[0] = np.cumsum(out[0], axis=0) & 255
    for y in range(1, height):
        out[y, 0] = (out[y, 0] + out[y - 1, 0]) & 255
        row = modes[y >> bits, :, 1] & 15
        if width > 1 and len(set(row.tolist())) == 1 and row[0] in (0, 1, 2, 4):
            if row[0] == 1:
                out[y] = np.cumsum(out[y], axis=0) & 255
            else:
                base = {0: np.array([0, 0, 0, 255]), 2: out[y - 1, 1:], 4: out[y - 1, :-1]}[int(row[0])]
                out[y, 1:] = (out[y, 1:] + base) & 255
            continue
        for x in range(1, width):
            out[y, x] = (out[y, x] + predicted(int(row[x >> bits]), *neighbours(out, y, x))) & 255
    return out.astype(np.uint8)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint8).astype(np.int8).astype(np.int64)


def _delta(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (_signed(t) * _signed(c)) >> 5


def cross_colour(p: np.ndarray, tiles: np.ndarray, bits: int, sign: int) -> np.ndarray:
    """Add (sign 1, the inverse) or take away (-1) what red and blue owe to green, and blue to red."""
    height, width, _ = p.shape
    t = tiles[np.arange(height)[:, None] >> bits, np.arange(width)[None, :] >> bits]
    red, green, blue = (p[..., c].astype(np.int64) for c in range(3))
    new_red = (red + sign * _delta(t[..., 2], green)) & 255
    true_red = new_red if sign > 0 else red
    new_blue = (blue + sign * (_delta(t[..., 1], green) + _delta(t[..., 0], true_red))) & 255
    return np.stack([new_red, green, new_blue, p[..., 3]], axis=-1).astype(np.uint8)


def unbundle(p: np.ndarray, palette: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Palette indices, 2**bits to a green sample, to colours; an index past the palette is transparent black."""
    index = p[..., 1]
    each = 8 >> bits
    if bits:
        x = np.arange(width)
        index = (index[:, x >> bits] >> ((x & ((1 << bits) - 1)) * each)) & ((1 << each) - 1)
    full = np.zeros((256, 4), np.uint8)
    full[: len(palette)] = palette
    return full[index]


def decode_vp8l(data: bytes) -> np.ndarray:
    return next(decode_all([data]))


def decode_all(streams: Sequence[bytes]) -> Iterator[np.ndarray]:
    """The images of streams, in order, many of them read side by side."""
    some, n = [], 0
    for data in streams:
        sides = int.from_bytes(data[1:5], "little")
        size = ((sides & 0x3FFF) + 1) * ((sides >> 14 & 0x3FFF) + 1)
        if some and (n + size > PIXELS or len(some) == IMAGES):
            yield from decode_some(some)
            some, n = [], 0
        some.append(data)
        n += size
    if some:
        yield from decode_some(some)


def decode_some(streams: list[bytes]) -> list[np.ndarray]:
    out: list[np.ndarray | None] = [None] * len(streams)
    going = [(k, image(data), None) for k, data in enumerate(streams)]
    while going:
        asked: dict[Callable[[list], list], list] = {}
        for k, of, answer in going:
            try:
                what, given = of.send(answer)
            except StopIteration as end:
                out[k] = end.value
            else:
                asked.setdefault(what, []).append((k, of, given))
        going = [(k, of, answer) for what, some in asked.items() for (k, of, _), answer in zip(some, what([x for _, _, x in some]), strict=True)]
    return out


def image(data: bytes) -> Generator[Asked, object, np.ndarray]:
    r = Bits(data)
    if r.read(8) != 0x2F:
        raise ValueError("not a lossless WebP stream")
    full, height = r.read(14) + 1, r.read(14) + 1
    r.read(1)
    if r.read(3):
        raise ValueError("unknown version")
    width, undo, seen = full, [], set()
    while r.read(1):
        kind = r.read(2)
        if kind in seen:
            raise ValueError("a transform is given twice")
        seen.add(kind)
        if kind in (PREDICTOR, CROSS):
            bits = r.read(3) + 2
            tiles = yield from read_pixels(r, (width + (1 << bits) - 1) >> bits, (height + (1 << bits) - 1) >> bits, False)
            undo.append((lambda p, t=tiles, b=bits: invert_predictor(p, t, b)) if kind == PREDICTOR else (lambda p, t=tiles, b=bits: cross_colour(p, t, b, 1)))
        elif kind == GREEN:
            undo.append(subtract_green_inverse)
        else:
            n = r.read(8) + 1
            palette = (np.cumsum((yield from read_pixels(r, n, 1, False))[0].astype(np.int64), axis=0) & 255).astype(np.uint8)
            bits = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            undo.append(lambda p, c=palette, w=width, b=bits: unbundle(p, c, w, b))
            width = (width + (1 << bits) - 1) >> bits
    p = yield from read_pixels(r, width, height, True)
    for f in reversed(undo):
        p = f(p)
    return p


def subtract_green_inverse(p: np.ndarray) -> np.ndarray:
    out = p.copy()
    out[..., 0] += p[..., 1]
    out[..., 2] += p[..., 1]
    return out


def frames(data: bytes) -> list[bytes]:
    """The VP8L streams of one or more WebP files that follow each other."""
    out, at = [], 0
    while at < len(data):
        if data[at : at + 4] != b"RIFF" or data[at + 8 : at + 16] != b"WEBPVP8L":
            raise ValueError("not a lossless WebP file")
        n = int.from_bytes(data[at + 16 : at + 20], "little")
        out.append(data[at + 20 : at + 20 + n])
        at += 8 + int.from_bytes(data[at + 4 : at + 8], "little")
    return out
