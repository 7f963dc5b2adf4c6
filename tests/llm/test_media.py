import cProfile
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomsift.llm import media, vp8l, vp8l_encode


def test_payloads_come_back(tables, nothing):
    for df in tables:
        for r, t in ((r, t) for r in media.describe(media.encode(df)).collect() for t in [None]):
            assert r.payload_bytes % 192 == 0 and r.payload_bytes > 0
        got = sorted(((r.doc_id, r.n_bytes, r.payload_sha256, r.tail_crc32) for r in media.describe(media.encode(df)).collect()), key=str)
        want = []
        for r in df.collect():
            raw = (r.text or "").encode()
            p = raw + b" " * (-len(raw) % 192 if raw else 192)
            want.append((r.doc_id, len(raw), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
        assert got == sorted(want, key=str)
    assert media.describe(media.encode(nothing)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=400), st.integers(1, 9))
def test_images_round_trip(data, width):
    n = -(-len(data) // (3 * width)) * 3 * width
    p = np.frombuffer(data.ljust(n), np.uint8).reshape(-1, width, 3)
    (got,) = (vp8l.decode_vp8l(x) for x in vp8l.frames(vp8l_encode.encode_rgb(p)))
    assert np.array_equal(got[..., :3], p) and (got[..., 3] == 255).all()


def test_stored_form(odd, corpus):
    """media_bytes, media_sha256 and feature against the stored bytes, read by hand; equal texts give equal values."""
    docs = odd.select("doc_id", "text").unionByName(corpus.select("doc_id", "text"))
    stored = {(r.doc_id, r.n_bytes, bytes(r.media)) for r in media.encode(docs).collect()}
    want = set()
    for i, n, m in stored:
        assert m[:4] == b"RIFF" and m[8:16] == b"WEBPVP8L" and len(m) == 8 + int.from_bytes(m[4:8], "little")
        p = np.concatenate(media.load(m))
        red, green, blue = (int(p[..., c].sum(dtype=np.int64)) for c in range(3))
        want.add((i, n, len(m), hashlib.sha256(m).hexdigest(), f"1x{len(p)}:{red},{green},{blue}"))
        raw = p[..., :3].tobytes()
        assert len(raw) % 192 == 0 and (p[..., 3] == 255).all()
    got = media.describe(media.encode(docs)).collect()
    assert {(r.doc_id, r.n_bytes, r.media_bytes, r.media_sha256, r.feature) for r in got} == want
    assert len({(r.payload_sha256, r.media_sha256, r.feature) for r in got}) == len({r.payload_sha256 for r in got})
    assert sum(r.media_bytes for r in got) < 0.6 * sum(r.payload_bytes for r in got)


@pytest.mark.parametrize("form", range(4))
@pytest.mark.parametrize("cache", [False, True])
def test_each_form_of_an_image(form, cache, monkeypatch):
    """Whatever form is chosen (plain, subtract-green, predictor left or top), with a cache or without, it comes back."""
    costs = iter(range(10**6))
    monkeypatch.setattr(vp8l_encode, "sample_bits", lambda p: 1e9 * cache if (k := next(costs)) >= 4 else abs(k - form))
    r = np.random.default_rng(form)
    for height, width in ((1, 700), (700, 1), (40, 64), (3, 5)):
        p = r.choice(r.integers(0, 256, (900, 3)).astype(np.uint8), (height, width))
        p[height // 2 :] = p[: height - height // 2]
        costs = iter(range(10**6))
        (x,) = vp8l.frames(vp8l_encode.encode_rgb(p))
        got = vp8l.decode_vp8l(x)
        assert np.array_equal(got[..., :3], p) and (got[..., 3] == 255).all()


def test_palettes_of_payloads():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 5, 16, 17, 200):
        colours = r.integers(0, 256, (n, 3)).astype(np.uint8)
        p = colours[r.integers(0, n, (30, 64))]
        (x,) = vp8l.frames(vp8l_encode.encode_rgb(p))
        got = vp8l.decode_vp8l(x)
        assert np.array_equal(got[..., :3], p) and (got[..., 3] == 255).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000) | st.just(0), min_size=1, max_size=280), st.integers(9, 15))
def test_code_lengths_make_a_whole_code(counts, limit):
    lengths = vp8l_encode.code_lengths(np.array(counts), limit)
    used = np.flatnonzero(counts)
    assert set(np.flatnonzero(lengths)) == set(used)
    if len(used) > 1:
        assert lengths.max() <= limit and sum(2.0 ** -lengths[used]) == 1
        order = sorted(used, key=lambda k: counts[k])
        assert all(lengths[a] >= lengths[b] for a, b in zip(order, order[1:]) if counts[a] < counts[b])
        w = vp8l_encode.Writer()
        vp8l_encode.write_code(w, lengths)
        w.put(0, 64)
        code = vp8l.read_code(vp8l.Bits(w.data()), len(counts))
        words = vp8l_encode.canonical(lengths)
        values = np.array([words[k] for k in used])
        symbols, sizes = code.look(values)
        assert symbols.tolist() == used.tolist() and sizes.tolist() == lengths[used].tolist()


def test_cache_entries_never_written():
    """An entry that no pixel has filled is transparent black, which belongs in another place."""
    cache = vp8l.Cache(2)
    argb = np.array([-1 - 3, 0xFF123456, -1 - 3, -1 - 0, 0xFF123456], np.int64)
    plain, held = [], [0] * 4
    for p in argb.tolist():
        p = held[-1 - p] if p < 0 else p
        held[int(cache.place(np.array([p]))[0])] = p
        plain.append(p)
    cache.resolve(argb, 0, 5)
    assert argb.tolist() == plain and cache.held.tolist() == held


def test_tall_payloads_are_several_images():
    data = bytes(range(64)) * 3 * (vp8l.SIDE + 5)
    images = media.load(media.store(data))
    assert [len(p) for p in images] == [vp8l.SIDE, 5] and b"".join(p[..., :3].tobytes() for p in images) == data


# --- streams with every feature, from a writer of their own ----------------------------------------------------------


def write_code(w, lengths):
    """A normal code; code lengths are written plainly, each in four bits' worth of a fixed code of 16."""
    w.put(0, 1)
    w.put(19 - 4, 4)
    for s in vp8l.LENGTH_ORDER:
        w.put(4 if s < 16 else 0, 3)
    w.put(0, 1)
    for n in lengths:
        w.put(int(f"{n:04b}"[::-1], 2), 4)
    order = sorted((n, s) for s, n in enumerate(lengths) if n)
    code, last, table = 0, 0, {}
    for n, s in order:
        code <<= n - last
        last = n
        table[s] = (int(f"{code:0{n}b}"[::-1], 2), n)
        code += 1
    return table if len(order) > 1 else {order[0][1]: (0, 0)}


def lengths_for(used, alphabet):
    """A lopsided complete code: lengths 1, 2, 3, ... and two of the last."""
    used = sorted(used)
    out = [0] * alphabet
    if len(used) == 1:
        out[used[0]] = 1
        return out
    if len(used) > 14:  # an even code with fillers
        n = (len(used) - 1).bit_length()
        for s in (used + [s for s in range(alphabet) if s not in set(used)])[: 1 << n]:
            out[s] = n
        return out
    for k, s in enumerate(used):
        out[s] = min(k + 1, len(used) - 1)
    return out


def prefix(value):
    """Prefix symbol, extra bits and their number of a length or distance."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    n = v.bit_length() - 1
    half = v >> (n - 1) & 1
    return 2 * n + half, v - ((2 + half) << (n - 1)), n - 1


def write_image(w, pixels, main, cache_bits=0, refs=True, meta=None):
    """Entropy-code pixels (list of rgba tuples, with the width) with cache hits and back-references where they are."""
    flat, width = pixels
    w.put(1 if cache_bits else 0, 1)
    if cache_bits:
        w.put(cache_bits, 4)
    groups = 1
    if main:
        w.put(1 if meta else 0, 1)
        if meta:
            bits, tiles, tile_width = meta
            w.put(bits - 2, 3)
            write_image(w, ([(g >> 8, g & 255, 0, 255) for g in tiles], tile_width), False)
            groups = max(tiles) + 1
    argb = [a << 24 | r << 16 | g << 8 | b for r, g, b, a in flat]
    cache, out, k = {}, [], 0
    slot = lambda p: ((vp8l.CACHE_HASH * p) & 0xFFFFFFFF) >> (32 - cache_bits)
    while k < len(argb):
        n, d = 0, 0
        for back in (1, width, 200):
            m = 0
            while refs and back <= k and k + m < len(argb) and argb[k + m] == argb[k + m - back] and m < 60:
                m += 1
            if m > max(n, 2):
                n, d = m, back
        if n:
            code = {1: 2, width: 1}.get(d, d + 120) if width > 1 else d + 120
            out.append((k, ("copy", n, code)))
        elif cache_bits and cache.get(slot(argb[k])) == argb[k]:
            n = 1
            out.append((k, ("cache", slot(argb[k]))))
        else:
            n = 1
            out.append((k, ("pixel", flat[k])))
        for p in argb[k : k + n]:
            if cache_bits:
                cache[slot(p)] = p
        k += n
    group = lambda k: meta[1][((k // width) >> meta[0]) * meta[2] + ((k % width) >> meta[0])] if main and meta else 0
    used = [[set() for _ in range(5)] for _ in range(groups)]
    for k, x in out:
        u = used[group(k)]
        if x[0] == "pixel":
            for j, c in enumerate((1, 0, 2, 3)):
                u[j].add(x[1][c])
        elif x[0] == "cache":
            u[0].add(280 + x[1])
        else:
            u[0].add(256 + prefix(x[1])[0])
            u[4].add(prefix(x[2])[0])
    size = 280 + (1 << cache_bits if cache_bits else 0)
    tables = [[write_code(w, lengths_for(s or {0}, n)) for s, n in zip(u, (size, 256, 256, 256, 40), strict=True)] for u in used]
    for k, x in out:
        t = tables[group(k)]
        if x[0] == "pixel":
            for j, c in enumerate((1, 0, 2, 3)):
                w.put(*t[j][x[1][c]])
        elif x[0] == "cache":
            w.put(*t[0][280 + x[1]])
        else:
            for table, base, value in ((t[0], 256, x[1]), (t[4], 0, x[2])):
                s, extra, n = prefix(value)
                w.put(*table[base + s])
                w.put(extra, n)


def header(w, width, height):
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(1, 1)
    w.put(0, 3)


def flat_of(p):
    return [tuple(x) for x in p.reshape(-1, 4).tolist()], p.shape[1]


def picture(height=19, width=23, colours=40, seed=0):
    r = np.random.default_rng(seed)
    some = r.integers(0, 256, (colours, 4))
    p = some[np.minimum(r.integers(0, colours, (height, width)), r.integers(0, colours, (height, width)))].astype(np.uint8)
    p[5:9] = p[1:5]
    return p


@pytest.mark.parametrize("cache_bits", [0, 3, 10])
@pytest.mark.parametrize("refs", [False, True])
def test_cache_and_back_references(cache_bits, refs):
    p, w = picture(), vp8l_encode.Writer()
    header(w, 23, 19)
    w.put(0, 1)
    write_image(w, flat_of(p), True, cache_bits, refs)
    assert np.array_equal(vp8l.decode_vp8l(w.data()), p)


def test_meta_prefix_groups():
    p, w = picture(), vp8l_encode.Writer()
    header(w, 23, 19)
    w.put(0, 1)
    write_image(w, flat_of(p), True, 2, True, (3, [0, 1, 2, 1, 0, 2, 2, 1, 0], 3))
    assert np.array_equal(vp8l.decode_vp8l(w.data()), p)


@pytest.mark.parametrize("mode", range(14))
def test_predictor(mode):
    p, w = picture(seed=mode), vp8l_encode.Writer()
    full = p.astype(np.int64)
    rest = np.zeros_like(full)
    for y in range(19):
        for x in range(23):
            if not y and not x:
                guess = np.array([0, 0, 0, 255])
            elif not y:
                guess = full[y, x - 1]
            elif not x:
                guess = full[y - 1, x]
            else:
                guess = vp8l.predicted(mode if x < 16 else 11, *vp8l.neighbours(full, y, x))
            rest[y, x] = (full[y, x] - guess) & 255
    header(w, 23, 19)
    w.put(0b001, 3)
    w.put(2, 3)  # tiles of 16
    write_image(w, ([(0, m, 0, 255) for m in (mode, 11, mode, 11)], 2), False)
    w.put(0, 1)
    write_image(w, flat_of(rest.astype(np.uint8)), True)
    assert np.array_equal(vp8l.decode_vp8l(w.data()), p)


def test_cross_colour_and_green():
    p, w = picture(), vp8l_encode.Writer()
    tiles = np.array([[[200, 30, 17, 255], [5, 250, 129, 255]], [[0, 0, 0, 255], [127, 128, 1, 255]]], np.uint8)
    inner = p.copy()
    inner[..., 0] -= p[..., 1]
    inner[..., 2] -= p[..., 1]
    coded = vp8l.cross_colour(inner, tiles, 4, -1)
    header(w, 23, 19)
    w.put(1 | vp8l.GREEN << 1, 3)
    w.put(1 | vp8l.CROSS << 1, 3)
    w.put(2, 3)
    write_image(w, flat_of(tiles), False)
    w.put(0, 1)
    write_image(w, flat_of(coded), True)
    assert np.array_equal(vp8l.decode_vp8l(w.data()), p)


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 9, 16, 40])
def test_palette(colours):
    p, w = picture(colours=colours), vp8l_encode.Writer()
    flat = p.reshape(-1, 4)
    palette, index = np.unique(flat, axis=0, return_inverse=True)
    index = index.reshape(19, 23)
    n = len(palette)
    bits = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
    each, wide = 8 >> bits, (23 + (1 << bits) - 1) >> bits
    packed = np.zeros((19, wide), np.int64)
    for x in range(23):
        packed[:, x >> bits] |= index[:, x] << ((x & ((1 << bits) - 1)) * each)
    green = np.zeros((19, wide, 4), np.uint8)
    green[..., 1], green[..., 3] = packed, 255
    delta = np.diff(palette.astype(np.int64), axis=0, prepend=np.zeros((1, 4), np.int64)) & 255
    header(w, 23, 19)
    w.put(1 | vp8l.PALETTE << 1, 3)
    w.put(n - 1, 8)
    write_image(w, ([tuple(x) for x in delta.tolist()], n), False)
    w.put(0, 1)
    write_image(w, flat_of(green), True)
    assert np.array_equal(vp8l.decode_vp8l(w.data()), p)


def test_broken_streams_are_errors():
    good = vp8l.frames(vp8l_encode.encode_rgb(picture()[..., :3]))[0]
    for bad in (b"", good[:30], b"x" + good[1:]):
        with pytest.raises(ValueError):
            vp8l.decode_vp8l(bad)


def test_lengths_of_few_symbols_and_bits_of_many_images_are_those_of_one():
    r = np.random.default_rng(3)
    for n in (0, 1, 2, 19):
        for most in (2, 50, 100_000):
            counts = r.integers(0, most, n)
            assert vp8l_encode.few_lengths(counts.tolist(), 7) == vp8l_encode.code_lengths(counts, 7).tolist()
    for n in (1, 700, 5000):
        forms = r.integers(0, 256, (4, n, 3)).astype(np.uint8)
        want = [sum(vp8l_encode.bits_of(np.bincount(x[:, c], minlength=256)) for c in range(3)) for x in forms]
        assert np.allclose(vp8l_encode.samples_bits(forms), want)


def many_payloads():
    """Texts, noise, few colours, repeats, one row, and a tall one, in turn."""
    r = np.random.default_rng(11)
    some = [b"%d %x " % (a, b) for a, b in r.integers(0, 1 << 40, (60, 2)).tolist()]
    out = []
    for k in range(3 * vp8l.FEW):
        n = int(r.integers(1, 900))
        out.append(
            (
                b"".join(some[j] for j in r.integers(0, 60, n)),
                r.integers(0, 256, 6 * n).astype(np.uint8).tobytes(),
                bytes(r.choice(np.frombuffer(b"ab ", np.uint8), 9 * n)),
                b"the same again, " * n,
                b"x" * (k % 200),
                b"".join(some[j] for j in r.integers(0, 4, n)) + r.integers(0, 256, n).astype(np.uint8).tobytes(),
            )[k % 6]
        )
    out.insert(5, b"tall" * (50 * vp8l.SIDE))
    return [x.ljust(max(1, -(-len(x) // media.UNIT)) * media.UNIT) for x in out]


def test_images_side_by_side_are_those_of_one():
    payloads = many_payloads()
    stored = media.store_all(payloads)
    assert stored == [media.store(x) for x in payloads]
    images = list(media.load_all(stored))
    assert [len(x) for x in images] == [-(-len(x) // (media.UNIT * vp8l.SIDE)) for x in payloads]
    assert [b"".join(p[..., :3].tobytes() for p in x) for x in images] == payloads
    assert all((p[..., 3] == 255).all() for x in images for p in x)
    assert all(np.array_equal(p, q) for x, y in zip(images, map(media.load, stored), strict=True) for p, q in zip(x, y, strict=True))
    assert media.store_all([]) == [] and list(media.load_all([])) == []


def test_calls_an_image():
    """A small image's cost is in calls: coding and reading took 1,014 a text before images were handled side by side."""
    profile = cProfile.Profile()
    r = np.random.default_rng(5)
    texts = [b" ".join(b"%x" % x for x in r.integers(0, 1 << 16, 190).tolist()).ljust(960)[:960] for _ in range(500)]
    profile.enable()
    assert len(list(media.load_all(media.store_all(texts)))) == len(texts)
    profile.disable()
    assert sum(x.callcount for x in profile.getstats()) < 500 * len(texts)


@pytest.mark.parametrize("form", range(4))
@pytest.mark.parametrize("cache", [False, True])
def test_forms_of_images_side_by_side(form, cache, monkeypatch):
    plain = vp8l_encode.planes_bits
    seen = []

    def bits(planes, image, many):
        if many % 4 == 0 and planes.shape[1] == 4 * n:
            seen.append(form)
            return np.tile(np.abs(np.arange(4) - form), many // 4).astype(float)
        return np.full(many, 1e9 if cache else 0.0) + 0 * plain(planes, image, many)

    monkeypatch.setattr(vp8l_encode, "planes_bits", bits)
    r = np.random.default_rng(form)
    for height, width, images in ((1, 700, 3), (700, 1, 2), (40, 64, 5), (3, 5, 1), (9, 64, 2 * vp8l.FEW)):
        made = []
        for _ in range(images):
            p = r.choice(r.integers(0, 256, (900, 3)).astype(np.uint8), (height, width))
            p[height // 2 :] = p[: height - height // 2]
            made.append(p)
        some = list(vp8l_encode.side_by_side(made))
        streams = []
        for part in some:
            n = sum(len(p) * width for p in part)
            streams += [vp8l.frames(x)[0] for x in vp8l_encode.encode_some(part)]
        for p, got in zip(made, vp8l.decode_all(streams), strict=True):
            assert np.array_equal(got[..., :3], p) and (got[..., 3] == 255).all()
    assert seen


def test_broken_streams_side_by_side_are_errors():
    good = vp8l.frames(media.store(b"".join(b"%d, " % (k * k) for k in range(900))[: 192 * 30]))[0]
    assert len(list(vp8l.decode_all([good] * 2 * vp8l.FEW))) == 2 * vp8l.FEW
    for bad in (good[: len(good) // 2], good[:30], b"x" + good[1:]):
        with pytest.raises(ValueError):
            list(vp8l.decode_all([good] * vp8l.FEW + [bad] + [good] * vp8l.FEW))
