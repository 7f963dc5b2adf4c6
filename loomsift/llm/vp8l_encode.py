"""Encoding of opaque images as lossless WebP (VP8L) streams.

Each image gets what shrinks it, by an estimate from its samples' entropies: a palette, or the predictor (left or top) or
subtract-green transform, or none; back-references to runs of pixels that came before; a colour cache; and canonical prefix
codes of the symbols that are left. Streams are a function of the pixels alone: small images are coded side by side, some
thousand pixels in each step of whole arrays, but nothing of one is used for another.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np

from loomsift.llm import vp8l

#: Shortest back-reference, longest one, longest prefix code, and most pixels of a colour-cache code.
LEAST, MOST, LIMIT, CACHE_BITS = 4, 4096, 12, 9
#: Symbols of the codes of green (with lengths and cached colours), of red and blue, and of distances.
ALPHABETS = (280 + (1 << CACHE_BITS), 256, 40)
#: Most pixels and images that are coded side by side; a larger image is coded alone.
PIXELS, IMAGES = 1 << 15, 256


class Writer:
    """Collects values in little-endian bit order."""

    def __init__(self) -> None:
        self.value = self.n = 0

    def put(self, value: int, n: int) -> None:
        self.value |= value << self.n
        self.n += n

    def data(self) -> bytes:
        return self.value.to_bytes((self.n + 7) // 8, "little")


def joined(values: np.ndarray, places: np.ndarray, size: int) -> bytes:
    """So many 32-bit words with values of at most 32 bits put at places, in bits, where they don't overlap."""
    word, bits = places >> 5, values.astype(np.uint64) << (places & 31).astype(np.uint64)
    # parts of a word don't overlap, so their sum, which doubles hold exactly, is their union
    low = np.bincount(word, (bits & np.uint64(0xFFFFFFFF)).astype(np.float64), size) + np.bincount(word + 1, (bits >> np.uint64(32)).astype(np.float64), size)
    return low.astype("<u4").tobytes()


def ranks(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each of these sizes."""
    return np.arange(sizes.sum()) - (sizes.cumsum() - sizes).repeat(sizes)


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of a prefix code for these counts, none over limit; one used symbol gets length 1."""
    out = np.zeros(len(counts), np.int64)
    used = counts.nonzero()[0]
    if len(used) < 2:
        out[used] = 1
        return out
    weights = counts[used]
    while True:
        order = weights.argsort(kind="stable")
        sizes = depths(weights[order].tolist())
        if max(sizes) <= limit:
            out[used[order]] = sizes
            return out
        weights = (weights + 1) >> 1


def few_lengths(counts: list[int], limit: int) -> list[int]:
    """:func:`code_lengths` of a few symbols."""
    out = [0] * len(counts)
    used = [s for s, n in enumerate(counts) if n]
    if len(used) < 2:
        for s in used:
            out[s] = 1
        return out
    while True:
        order = sorted(used, key=counts.__getitem__)
        sizes = depths([counts[s] for s in order])
        if max(sizes) <= limit:
            for s, n in zip(order, sizes, strict=True):
                out[s] = n
            return out
        counts = [(n + 1) >> 1 for n in counts]


def depths(weights: list[int]) -> list[int]:
    """How deep each of two or more leaves, in order of weight, is in their Huffman tree."""
    n = len(weights)
    leaves, inner = [*weights, 1 << 62], [1 << 62] * n
    over_leaf, over_inner = [0] * n, [0] * n
    i = j = 0
    for made in range(n - 1):  # the two lightest of the leaves and inner nodes left, both in order of weight
        if leaves[i] <= inner[j]:
            weight = leaves[i]
            over_leaf[i] = made
            i += 1
        else:
            weight = inner[j]
            over_inner[j] = made
            j += 1
        if leaves[i] <= inner[j]:
            weight += leaves[i]
            over_leaf[i] = made
            i += 1
        else:
            weight += inner[j]
            over_inner[j] = made
            j += 1
        inner[made] = weight
    depth = [1] * n
    for k in range(n - 3, -1, -1):
        depth[k] = depth[over_inner[k]] + 1
    return [depth[k] for k in over_leaf]


def many_lengths(counts: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """:func:`code_lengths` of many codes, whose symbols stand one after the other; row: each symbol's code."""
    used = counts.nonzero()[0]
    # in order of codes, then of counts, which are below 2**22, then of symbols
    key = row.take(used) << 48 | counts.take(used) << 26 | used
    key.sort()
    used, weights = key & 0x3FFFFFF, (key >> 26 & 0x3FFFFF).tolist()
    sizes, at = [], 0
    for c, n in enumerate(np.bincount(key >> 48, minlength=rows).tolist()):
        if n < 2:
            sizes += [1] * n
        else:
            made = depths(weights[at : at + n])
            if max(made) > LIMIT:
                made = code_lengths(counts[row == c], LIMIT)[used[at : at + n] - int(row.searchsorted(c))].tolist()
            sizes += made
        at += n
    out = np.zeros(len(counts), np.int64)
    out[used] = sizes
    return out


def many_words(lengths: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol's code, its first bit lowest, and size, of many codes; a code's single symbol takes no bits."""
    used = lengths.nonzero()[0]
    of = row.take(used)
    many = np.bincount(of, minlength=rows).take(of) > 1
    used = used[many]
    key = of[many] << 48 | lengths.take(used) << 26 | used
    key.sort()
    used, size = key & 0x3FFFFFF, key >> 26 & 15
    span = 1 << (15 - size)
    word, sizes = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    # each whole code's spans add up to 2**15
    word[used], sizes[used] = vp8l.turned(15).take(span.cumsum() - span & 0x7FFF) & ((1 << size) - 1), size
    return word, sizes


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol, its first bit lowest."""
    return many_words(lengths, np.zeros(len(lengths), np.int64), 1)[0]


def write_code(w: Writer, lengths: np.ndarray) -> None:
    """Write one code as :func:`descriptions` has it."""
    of, places, values, sizes = descriptions(lengths, np.zeros(len(lengths), np.int64), 1)
    w.put(int.from_bytes(joined(values, places, int(sizes[0] >> 5) + 2), "little"), int(sizes[0]))


ORDER = np.array(vp8l.LENGTH_ORDER)


def descriptions(lengths: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What describes codes: values with their code and place in its description, in bits, and each description's size.

    Simple for up to two symbols below 256, else lengths as runs under a code of their own.
    """
    used = lengths.nonzero()[0]
    number = np.bincount(row.take(used), minlength=rows)
    first, end = row.searchsorted(np.arange(rows)), number.cumsum()
    last = used.take(end - 1, mode="clip") - first if len(used) else first
    simple = (number == 0) | (number < 3) & (last < 256)
    said, size = [0] * rows, np.zeros(rows, np.int64)
    for c in simple.nonzero()[0].tolist():
        low, *high = (used[end[c] - number[c] : end[c]] - first[c]).tolist() or [0]
        n = 11 if low > 1 else 4
        said[c] = 1 | len(high) << 1 | (low > 1) << 2 | low << 3 | (high[0] << n if high else 0)
        size[c] = n + 8 * len(high)
    codes = np.arange(rows)
    if simple.all():
        return codes, np.zeros(rows, np.int64), np.array(said), size
    some = ~simple[row]
    lengths, row = lengths[some], row[some]
    # runs of one length: so many symbols of it, then so many whole repeats of the most, then one of the rest or symbols
    at = np.append(((lengths[1:] != lengths[:-1]) | (row[1:] != row[:-1])).nonzero()[0], len(lengths) - 1)
    left, value, of = np.diff(at, prepend=-1), lengths.take(at), row.take(at)
    none = value == 0
    before = np.where(none, 0, 1)
    whole, rest = np.divmod(left - before, np.where(none, 138, 6))
    number = before + whole + np.where(rest < 3, rest, 1)
    k = ranks(number) - before.repeat(number)
    value, rest, whole, none, of = (x.repeat(number) for x in (value, rest, whole, none, of))
    inner = (k >= 0) & (k < whole)
    count = np.where(inner, np.where(none, 138, 6), np.where((k < whole) | (rest < 3), 0, rest))
    short = none & (count < 11)
    symbol = np.where(count == 0, value, np.where(none, np.where(short, 17, 18), 16))
    more = np.where(count == 0, 0, np.where(none, np.where(short, 3, 7), 2))
    extra = np.where(count == 0, 0, np.where(short | ~none, count - 3, count - 11))
    slot = of * 19 + symbol
    uses = np.bincount(slot, minlength=19 * rows).reshape(rows, 19)
    kinds = np.zeros((rows, 19), np.int64)
    normal = (~simple).nonzero()[0]
    kinds[normal] = [few_lengths(x, 7) for x in uses[normal].tolist()]
    word, bits = many_words(kinds.ravel(), codes.repeat(19), rows)
    kinds = kinds[normal][:, ORDER]
    most = np.maximum(4, 19 - (kinds[:, ::-1] > 0).argmax(1))
    here = bits.take(slot)
    value, step = word.take(slot) | extra << here, here + more
    begin = np.zeros(rows, np.int64)
    begin[normal] = 6 + 3 * most
    went = step.cumsum()
    sums = np.zeros(rows, np.int64)
    sums[normal] = np.diff(went[np.append((of[1:] != of[:-1]).nonzero()[0], len(of) - 1)], prepend=0)
    size += begin + sums
    place = went - step - (sums.cumsum() - sums).take(of) + begin.take(of)
    heads = np.array(said)
    heads[normal] = (most - 4) << 1
    which, at = kinds.nonzero()
    return (
        np.concatenate([codes, normal[which], of]),
        np.concatenate([np.zeros(rows, np.int64), 5 + 3 * at, place]),
        np.concatenate([heads, kinds[which, at], value]),
        size,
    )


#: n * log2(n) of the smallest counts.
TIMES_LOG = np.arange(1 << 12) * np.log2(np.maximum(np.arange(1 << 12), 1))


def entropies(counts: np.ndarray, symbols: int, totals: np.ndarray) -> np.ndarray:
    """The entropies, in bits altogether, of alphabets of so many symbols with these counts and totals."""
    logs = TIMES_LOG.take(counts, mode="clip")
    if totals.max(initial=0) >= len(TIMES_LOG):
        large = (counts >= len(TIMES_LOG)).nonzero()[0]
        logs[large] = counts[large] * np.log2(counts[large])
    return totals * np.log2(np.maximum(totals, 1)) - logs.reshape(-1, symbols).sum(1)


def bits_of(counts: np.ndarray) -> float:
    """The entropy of symbols with these counts, in bits altogether."""
    return float(entropies(counts, len(counts), counts.sum(keepdims=True))[0]) if len(counts) else 0.0


def sample_bits(p: np.ndarray) -> float:
    """The entropies of red, green and blue, in bits altogether."""
    return samples_bits(p[None])[0]


def samples_bits(forms: np.ndarray) -> list[float]:
    """:func:`sample_bits` of images of one size."""
    many, n = forms.shape[:2]
    return planes_bits(forms.transpose(2, 0, 1).reshape(3, -1), np.arange(many).repeat(n), many).tolist()


def planes_bits(planes: np.ndarray, image: np.ndarray, many: int) -> np.ndarray:
    """:func:`sample_bits` of many images' reds, greens and blues."""
    counts = np.bincount((image * 768 + PLANES + planes).ravel(), minlength=768 * many)
    return entropies(counts, 256, np.bincount(image, minlength=many).repeat(3)).reshape(-1, 3).sum(1)


#: Where an image's counts of red, green and blue begin.
PLANES = np.arange(0, 768, 256)[:, None]


def earlier_runs(px: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, distance) of runs of LEAST pixels or more that stood before in their image, in order, without overlap."""
    n = len(px) - LEAST + 1
    if n < 2:
        return []
    key = px[:n]
    for j in range(1, LEAST):
        key = key * 0x9E3779B1 + px[j : n + j] & 0xFFFFFFFFFFFF
    # in order of images, of keys, then of places, which are below 2**20
    key = (key * 0x9E3779B1 >> 5 & 0x7FFFFFFFFFF) << 20
    begins = sizes.cumsum() - sizes
    same = np.zeros(n, bool)
    begin_of = np.zeros(n, np.int64)
    for a, size in zip(begins.tolist(), (sizes - LEAST + 1).tolist(), strict=True):
        if size > 1:
            part = key[a : a + size]
            part |= PLACES[:size] if size <= len(PLACES) else np.arange(size)
            part.sort()
            same[a + 1 : a + size] = (part[1:] ^ part[:-1]) < 1 << 20
            begin_of[a : a + size] = a
    same = same.nonzero()[0]
    at, before, first = key[same] & 0xFFFFF, key[same - 1] & 0xFFFFF, begin_of[same]
    at, before = at + first, before + first
    if len(at):
        real = px[at] == px[before]
        for j in range(1, LEAST):
            real &= px[at + j] == px[before + j]
        at, before = at[real], before[real]
    if not len(at):
        return []
    distance = np.zeros(n + 2, np.int64)
    distance[at + 1] = at - before
    edge = (distance[1:] != distance[:-1]).nonzero()[0]
    distance = distance[1:]
    out, free = [], 0
    for a, z, d in zip(edge[:-1].tolist(), edge[1:].tolist(), distance[edge[:-1]].tolist(), strict=True):
        if d:
            a, z = max(a, free), z + LEAST - 1
            while z - a >= LEAST:
                k = min(z - a, MOST)
                out.append((a, k, d))
                a = free = a + k
    return out


#: Places of an image's first pixels.
PLACES = np.arange(PIXELS)


@functools.lru_cache(maxsize=8)
def near_codes(width: int) -> dict[int, int]:
    """The least code of each distance that a neighbouring place has."""
    out: dict[int, int] = {}
    for k, (x, y) in enumerate(vp8l.NEAR):
        out.setdefault(max(1, x + y * width), k + 1)
    return out


@functools.lru_cache(maxsize=1 << 14)
def prefixed(value: int) -> tuple[int, int, int]:
    """Prefix symbol of a length or distance, its extra bits, and their number."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    n = v.bit_length() - 1
    return 2 * n + (v >> (n - 1) & 1), v & ((1 << (n - 1)) - 1), n - 1


def cache_hits(argb: np.ndarray, image: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pixel's place in its image's colour cache, and whether that holds the pixel when its turn comes."""
    place = ((vp8l.CACHE_HASH * argb) & 0xFFFFFFFF) >> (32 - bits)
    key = (image << CACHE_BITS | place) << 28 | np.arange(len(argb))
    key.sort()
    order = key & 0xFFFFFFF
    held = argb.take(order)
    hit = np.zeros(len(argb), bool)
    hit[order[1:]] = (key[1:] ^ key[:-1] < 1 << 28) & (held[1:] == held[:-1])
    return place, hit


def write_pixels(ws: Sequence[Writer], planes: np.ndarray, sizes: np.ndarray, widths: Sequence[int], alpha: np.ndarray, main: bool) -> None:
    """Entropy-code images, each of one alpha, with what shrinks them; planes: their reds, greens and blues, one image after the other."""
    many = len(ws)
    image = np.arange(many).repeat(sizes)
    red, green, blue = planes = planes.astype(np.int64)
    argb = (alpha << 24).repeat(sizes) | red << 16 | green << 8 | blue
    refs = earlier_runs(argb, sizes)
    alone = np.ones(len(argb), bool)
    for a, n, _ in refs:
        alone[a : a + n] = False
    bits = np.array([min(CACHE_BITS, max(1, n.bit_length() - 1)) for n in sizes.tolist()])
    place, hit = cache_hits(argb, image, bits.repeat(sizes))
    hit &= alone
    # a cached pixel takes about the bits of its place and one more; each place that is used takes some of the code's own lengths
    uses = np.bincount((image << CACHE_BITS | place)[hit], minlength=many << CACHE_BITS)
    number = uses.reshape(many, -1).sum(1)
    left, in_image = (planes, image) if alone.all() else (planes[:, alone], image[alone])
    saved = planes_bits(left, in_image, many) / np.maximum(1, np.bincount(in_image, minlength=many)) * number
    saved -= entropies(uses, 1 << CACHE_BITS, number) + number + 4 * np.count_nonzero(uses.reshape(many, -1), axis=1)
    bits[saved < 256] = 0
    hit &= (bits > 0).repeat(sizes)
    copies = []
    for (a, n, d), i in zip(refs, image[[a for a, _, _ in refs]].tolist() if refs else [], strict=True):
        copies.append((a, i, *prefixed(n), *prefixed(near_codes(widths[i]).get(d, d + 120))))
    begin, of, length, length_bits, length_more, dist, dist_bits, dist_more = np.array(copies, np.int64).reshape(-1, 8).T
    # each image's codes: green, lengths and cached colours; red and blue, which share their code's lengths; distances
    at, known = (alone & ~hit).nonzero()[0], hit.nonzero()[0]
    row = np.arange(3 * many).repeat(np.array(ALPHABETS).repeat(many))
    first = many * np.array([0, ALPHABETS[0], ALPHABETS[0] + ALPHABETS[1]])
    in_image = image.take(at)
    to_green, to_both = in_image * ALPHABETS[0], in_image * ALPHABETS[1] + first[1]
    greens, reds, blues = green.take(at) + to_green, red.take(at) + to_both, blue.take(at) + to_both
    cached = 280 + place.take(known) + image.take(known) * ALPHABETS[0]
    length, dist = length + 256 + of * ALPHABETS[0], dist + of * ALPHABETS[2] + first[2]
    lengths = many_lengths(np.bincount(np.concatenate([greens, length, cached, reds, blues, dist]), minlength=len(row)), row, 3 * many)
    word, size = many_words(lengths, row, 3 * many)
    # an image without a cache, or with a small one, has fewer symbols
    real = np.ones(len(row), bool)
    real[: first[1]] = (np.arange(ALPHABETS[0]) < (280 + np.where(bits, 1 << bits, 0))[:, None]).ravel()
    code, code_place, code_value, code_size = descriptions(lengths[real], row[real], 3 * many)
    # two values a pixel: green and red, and blue; a cached one's place; or a copy's length and distance, with their extra bits
    value, step = np.zeros(2 * len(argb), np.int64), np.zeros(2 * len(argb), np.int64)
    at, known, begin = 2 * at, 2 * known, 2 * begin
    here = size.take(greens)
    value[at], step[at] = word.take(greens) | word.take(reds) << here, here + size.take(reds)
    at += 1
    value[at], step[at] = word.take(blues), size.take(blues)
    value[known], step[known] = word.take(cached), size.take(cached)
    if len(begin):
        value[begin], step[begin] = word[length] | length_bits << size[length], size[length] + length_more
        begin += 1
        value[begin], step[begin] = word[dist] | dist_bits << size[dist], size[dist] + dist_more
    went = step.cumsum()
    sums = np.diff(went[2 * sizes.cumsum() - 1], prepend=0)
    # an image's stream: its cache, the codes (that of red twice; alpha's has one symbol), the pixels
    flags = np.where(bits, 1 | bits << 1, 0)
    greens_at = np.where(bits, 5, 1) + main
    sizes_of = code_size.reshape(3, many)
    reds_at = greens_at + sizes_of[0]
    blues_at = reds_at + sizes_of[1]
    alpha_at = blues_at + sizes_of[1]
    dist_at = alpha_at + np.where(alpha > 1, 11, 4)
    pixels_at = dist_at + sizes_of[2]
    total = pixels_at + sums
    held = (total >> 5) + 2
    base = (held.cumsum() - held) << 5
    code_at = np.concatenate([base + greens_at, base + reds_at, base + dist_at])
    again = ((code >= many) & (code < 2 * many)).nonzero()[0]
    shift = base + pixels_at - (sums.cumsum() - sums)
    some = step.nonzero()[0]
    out = joined(
        np.concatenate([flags, np.where(alpha > 1, 5 | alpha << 3, 1 | alpha << 3), code_value, code_value[again], value[some]]),
        np.concatenate([base, base + alpha_at, code_at[code] + code_place, (base + blues_at)[code[again] - many] + code_place[again], (went - step + shift.repeat(2 * sizes))[some]]),
        int(held.sum()),
    )
    for w, a, n in zip(ws, (base >> 3).tolist(), total.tolist(), strict=True):
        w.put(int.from_bytes(out[a : a + (n + 7 >> 3)], "little"), n)


def with_palette(w: Writer, p: np.ndarray) -> np.ndarray:
    """Write the image's colours; what is left is their numbers, some to a pixel."""
    height, width, _ = p.shape
    flat = p.reshape(-1, 3).astype(np.int64)
    colours, index = np.unique(flat[:, 0] << 16 | flat[:, 1] << 8 | flat[:, 2], return_inverse=True)
    n = len(colours)
    bits = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
    each, wide = 8 >> bits, (width + (1 << bits) - 1) >> bits
    w.put(1 | vp8l.PALETTE << 1, 3)
    w.put(n - 1, 8)
    palette = np.stack([colours >> 16, colours >> 8 & 255, colours & 255], axis=1).astype(np.uint8)
    # each colour less the one before; all but the first are then clear, so alpha is written out
    write_clear(w, np.diff(palette, axis=0, prepend=np.zeros((1, 3), np.uint8)))
    packed = np.zeros((height, wide), np.int64)
    rows = index.reshape(height, width)
    for x in range(1 << bits):
        part = rows[:, x :: 1 << bits]
        packed[:, : part.shape[1]] |= part << (x * each)
    green = np.zeros((height, wide, 3), np.uint8)
    green[..., 1] = packed
    return green


def write_clear(w: Writer, p: np.ndarray) -> None:
    """A row of few pixels as literals, the first with alpha 255, the others with 0."""
    alpha = np.zeros(len(p), np.int64)
    alpha[0] = 255
    w.put(0, 1)
    alphabets = np.array([280, 256, 256, 256, 40])
    row = np.arange(5).repeat(alphabets)
    symbols = (np.stack([p[:, 1], p[:, 0], p[:, 2], alpha], axis=1) + (alphabets.cumsum() - alphabets)[:4]).ravel()
    lengths = many_lengths(np.bincount(symbols, minlength=len(row)), row, 5)
    word, size = many_words(lengths, row, 5)
    code, place, value, sizes = descriptions(lengths, row, 5)
    step = size.take(symbols)
    ends = step.cumsum() + sizes.sum()
    n = int(ends[-1])
    out = joined(np.concatenate([value, word.take(symbols)]), np.concatenate([(sizes.cumsum() - sizes)[code] + place, ends - step]), (n >> 5) + 2)
    w.put(int.from_bytes(out, "little"), n)


def forms_of(planes: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The samples of images of one width as they are, less green, and less their prediction from the left and the top.

    The first row and column are predicted as the format has them.
    """
    out = np.stack([planes] * 4)
    _, less, left, top = out
    less[0] -= planes[1]
    less[2] -= planes[1]
    begins = sizes.cumsum() - sizes
    left[:, 1:] -= planes[:, :-1]
    rows = np.arange(0, planes.shape[1], width)
    left[:, rows[1:]] = planes[:, rows[1:]] - planes[:, rows[:-1]]
    left[:, begins] = planes[:, begins]
    top[:, width:] -= planes[:, :-width]
    for a in begins.tolist():
        top[:, a : a + width] = left[:, a : a + width]
    return out


def encode_rgb(p: np.ndarray) -> bytes:
    """A WebP file of an opaque image, shape (height, width, 3)."""
    return encode_all([p])[0]


def encode_all(images: Sequence[np.ndarray]) -> list[bytes]:
    """WebP files of opaque images of one width, each shape (height, width, 3)."""
    return [x for some in side_by_side(images) for x in encode_some(some)]


def side_by_side(images: Sequence[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The images in order, some thousand pixels together."""
    some, n = [], 0
    for p in images:
        size = p.shape[0] * p.shape[1]
        if some and (n + size > PIXELS or len(some) == IMAGES):
            yield some
            some, n = [], 0
        some.append(p)
        n += size
    if some:
        yield some


def encode_some(images: list[np.ndarray]) -> list[bytes]:
    many, width = len(images), images[0].shape[1]
    sizes = np.array([len(p) * width for p in images])
    flat = np.concatenate(images).reshape(-1, 3)
    image = np.arange(many).repeat(sizes)
    planes = np.ascontiguousarray(flat.T)
    red, green, blue = planes.astype(np.int64)
    colour = image << 24 | red << 16 | green << 8 | blue
    colour.sort()
    number = np.bincount(colour[np.append(True, colour[1:] != colour[:-1])] >> 24, minlength=many)
    few = (number <= 256) & (4 * number <= sizes)
    forms = forms_of(planes, sizes, width)
    cost = planes_bits(forms.transpose(1, 0, 2).reshape(3, -1), (image * 4 + np.arange(4)[:, None]).ravel(), 4 * many).reshape(many, 4)
    best = np.where(few, 0, cost.argmin(1))
    ws, parts, wide = [], [], []
    for p, a, n, palette, form in zip(images, (sizes.cumsum() - sizes).tolist(), sizes.tolist(), few.tolist(), best.tolist(), strict=True):
        w = Writer()
        w.put(0x2F | width - 1 << 8 | len(p) - 1 << 22, 8 + 14 + 14)
        w.put(0, 1 + 3)  # opaque, version 0
        if palette:
            left = with_palette(w, p)
            parts.append(left.reshape(-1, 3).T)
            wide.append(left.shape[1])
        else:
            if form == 1:
                w.put(1 | vp8l.GREEN << 1, 3)
            elif form:
                write_predictor(w, len(p), width, form - 1)
            parts.append(forms[form, :, a : a + n])
            wide.append(width)
        w.put(0, 1)
        ws.append(w)
    # what is left of alpha after a prediction is 0
    write_pixels(ws, np.concatenate(parts, axis=1), np.array([x.shape[1] for x in parts]), wide, np.where(best < 2, 255, 0), True)
    return [wrapped(w.data()) for w in ws]


def write_predictor(w: Writer, height: int, width: int, mode: int) -> None:
    tile = min(9, max(2, (max(width, height) - 1).bit_length()))
    rows, across = ((height - 1) >> tile) + 1, ((width - 1) >> tile) + 1
    tiles = np.zeros((3, rows * across), np.uint8)
    tiles[1] = mode
    w.put(1 | vp8l.PREDICTOR << 1, 3)
    w.put(tile - 2, 3)
    write_pixels([w], tiles, np.array([rows * across]), [across], np.array([255]), False)


def wrapped(stream: bytes) -> bytes:
    """A WebP file of one VP8L stream."""
    body = stream + b"\0" * (len(stream) & 1)
    return b"RIFF" + (12 + len(body)).to_bytes(4, "little") + b"WEBPVP8L" + len(stream).to_bytes(4, "little") + body
