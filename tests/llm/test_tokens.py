import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loomsift.llm import bpe, packing, secrets, tokens


def little(ids):
    return np.array(ids, "<u4").tobytes()


def library(name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.encode_special_tokens = True
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("chunk", "overlap"), [(7, 3), (64, 16), (bpe.CHUNK, bpe.OVERLAP)])
def test_bpe_is_the_library_s(tables, texts, chunk, overlap):
    enc = secrets.vocabulary(public_tokenizers.path(bpe.VOCABULARY))
    for df in tables if chunk > 7 else tables[:1]:
        want = sorted(((i, len(x := enc.encode_ordinary(t or "")), hashlib.sha256(little(x)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts(df)), key=str)
        assert sorted(map(tuple, bpe.tokenise(df, digest=True, chunk=chunk, overlap=overlap).collect()), key=str) == want


def test_bpe_gives_ids_and_bytes(odd, nothing):
    got = {(r.doc_id, bytes(r.decoded)) for r in bpe.tokenise(odd, chunk=50, overlap=20).collect()}
    assert got == {(r.doc_id, (r.text or "").encode()) for r in odd.collect()}
    assert bpe.tokenise(nothing).collect() == []


def test_bpe_stitches_texts_without_white_space(spark):
    """An unbroken text is the work of many tasks: no chunk keeps its text to be joined with others."""
    enc = secrets.vocabulary(public_tokenizers.path(bpe.VOCABULARY))
    r = np.random.default_rng(5)
    han = "".join(map(chr, r.integers(0x4E00, 0x9FA5, 500)))
    some = lambda alphabet, n: "".join(r.choice(list(alphabet), n))
    rows = [(1, (han + "，" + han[:77] + "。") * 60), (2, some("0123456789abcdefABCDEF", 40_000)), (3, some("ก็ขา้ที่", 40_000)), (4, some("don't's'll've", 40_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = bpe.chunks(df, public_tokenizers.path(bpe.VOCABULARY), bpe.CHUNK, bpe.OVERLAP)
    assert made.where("text is not null").count() == 0 and made.count() == 12
    rows.append((5, "x" * 40_000 + "7" * 40_000))  # two pre-tokens
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: bytes(x.ids) for x in bpe.tokenise(df).collect()}
    assert got == {i: little(enc.encode_ordinary(t)) for i, t in rows}


def test_boundaries_are_the_pattern_s():
    """Whatever the scan began with, a pre-token ends at each of them: every character of the classes beside some of each."""
    split = regex.compile(public_tokenizers.PATTERN).findall
    chars = [chr(k) for k in range(0x10000) if not 0xD800 <= k < 0xE000]
    found = set()
    for c in chars:
        for t in (t for d in "aé漢7²,'\u0301\n " for x in (d + c, c + d) for t in (x, "'" + x, " " + x + "l")):
            m = bpe.boundaries().search(t)
            if m:
                found.add(c)
                assert m.end() in np.cumsum([len(x) for x in split(t)]), ascii(t)
    assert len(found) > 40_000


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abLs 7²é,.'’\n\t漢ก\u0e31\u0301😀", max_size=40), st.integers(1, 30))
def test_scans_resynchronise_at_boundaries(text, start):
    """A scan that begins anywhere before a boundary has a pre-token end there."""
    split = regex.compile(public_tokenizers.PATTERN).findall
    for m in bpe.boundaries().finditer(text):
        for k in {0, min(start, m.end() - 1)}:
            assert m.end() - k in np.cumsum([len(x) for x in split(text[k:])])


PIECES = [tokens.Encoder(public_tokenizers.path(v), s, most=20) for v, s in ((tokens.VOCABULARY, True), (packing.VOCABULARY, False))]
LIBRARY = [library(tokens.VOCABULARY), library(packing.VOCABULARY)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab Zé,.'sS0² \n\t! ́İΣς’<\u0338\x00\x1c\xa0\u3000|<>漢", max_size=30), max_size=4))
def test_memory_gives_the_tokenizer_s_ids(texts):
    for enc, lib in zip(PIECES, LIBRARY, strict=True):
        assert enc.encode(texts) == [little(lib(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=4))
def test_memory_gives_the_tokenizer_s_ids_for_any_text(texts):
    for enc, lib in zip(PIECES, LIBRARY, strict=True):
        assert enc.encode(texts) == [little(lib(t)) for t in texts]


def test_every_low_character_beside_others():
    for enc, lib in zip([tokens.Encoder(public_tokenizers.path(v), s) for v, s in ((tokens.VOCABULARY, True), (packing.VOCABULARY, False))], LIBRARY, strict=True):
        texts = [t for k in range(0x260) for c in [chr(k)] for t in (c + ".", c + ",x", "a" + c + ".", c + c, f" {c} {c}b", f"{c}'s 7{c}8", f"\n{c}\n", f"e{c}\u0301")]
        assert enc.encode(texts) == [little(lib(t)) for t in texts]


@pytest.mark.parametrize("contraction", ["'s", "'T", "'re", "'Ve", "'m", "'LL", "'d"])
def test_contractions_before_every_character(contraction):
    """All code points of the basic plane, and a seventeenth of those above."""
    points = [chr(k) for k in (*range(0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 17))]
    for enc, lib in zip([tokens.Encoder(public_tokenizers.path(v), s) for v, s in ((tokens.VOCABULARY, True), (packing.VOCABULARY, False))], [tokens.tokenizer(public_tokenizers.path(v)) for v in (tokens.VOCABULARY, packing.VOCABULARY)], strict=True):
        for k in range(0, len(points), 20_000):
            texts = [f"it{contraction}{c}" for c in points[k : k + 20_000]]
            assert enc.encode(texts) == [little(x.ids) for x in lib.encode_batch(texts, add_special_tokens=False)]


def test_contractions_in_common_english():
    enc, lib = tokens.Encoder(public_tokenizers.path(packing.VOCABULARY), False), library(packing.VOCABULARY)
    texts = ["it's”", "don't’", "she's…", "'s€", "'s😀", "'t́", "'ſ", "it's中", "he'Ś̖", "we'LL—see"]
    assert enc.encode(texts) == [little(lib(t)) for t in texts]


def test_cut_by_classes_is_the_pattern():
    """Every character that it tells, beside spaces, quotes, contractions and the ends of texts."""
    find = tokens.pattern(True).findall
    texts = [t for k in range(0x250) for c in [chr(k)] if not tokens.SEPARATOR.search(c) for t in (c, f"a{c}", f"{c}'s", f"'{c}", f" {c}  {c} ", f"'re{c}'ll", f"{c}{c} '{c}", f"\n{c} \n")]
    told = [t for t in texts if not tokens.IS_FURTHER.search(t)]
    data = np.frombuffer("\x1c".join(["", *told, ""]).encode(), np.uint8)
    begin, odd = tokens.cut(data)
    ends = [*begin[1:].tolist(), len(data)]
    got = [data[a:z].tobytes().decode() for a, z in zip(begin.tolist(), ends, strict=True)]
    assert not len(odd) and got == [x for t in told for x in ["\x1c", *find(t)]] + ["\x1c"]
    assert len(tokens.cut(np.frombuffer("\x1ca\u0130b 漢\x1c".encode(), np.uint8))[1]) == 2


def test_tasks_of_a_job_share_pre_tokens():
    """Pre-tokens that one task met are looked up by the next; another job begins anew."""
    path = public_tokenizers.path(tokens.VOCABULARY)
    one = tokens.shared_encoder(path, True, "one")
    made, make = [], one.memory.make
    one.memory.make = lambda new: [made.extend(new), make(new)][1]
    first = one.encode(["some words it's  that\nrepeat", "some words"])
    assert tokens.shared_encoder(path, True, "one").encode(["that repeat some words", None]) == [little(LIBRARY[0]("that repeat some words")), b""]
    assert len(made) == len(set(made)) and made.count(" words") == 1
    assert tokens.shared_encoder(path, True, "two") is not one and tokens.shared_encoder(path, True, "two").encode(["some words"]) == first[1:]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=200))
def test_blocks_round_trip(ids):
    x = np.array(ids, np.uint32)
    assert np.array_equal(tokens.unpack(b"??" + tokens.pack(x), 2), x)


def test_block_width_follows_the_percentile():
    x = np.array([7] * 95 + [1 << 20] * 5, np.uint32)
    assert len(tokens.pack(x)) == tokens.HEADER.size + 5 * 6


def test_token_files(tables, nothing, texts):
    lib = library(tokens.VOCABULARY)
    for df in tables:
        at, want = 0, []
        for i, t in sorted(texts(df), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
            ids = [*lib(t), tokens.END_ID]
            want.append((i, at, len(ids), little(ids), zlib.crc32(little(ids))))
            at += len(ids)
        got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) for r in tokens.read(tokens.write(df, shards=3)).orderBy("start").collect()]
        assert got == want
    assert tokens.read(tokens.write(nothing)).collect() == []


def test_token_files_have_a_place(corpus, tmp_path):
    out = f"file://{tmp_path}/tokens"
    here = tokens.write(corpus, out)
    again = corpus.sparkSession.read.parquet(out)
    assert sorted(map(tuple, tokens.read(again, with_ids=False).collect())) == sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens.read(here).collect())


def test_tournament_is_first_fit():
    r = np.random.default_rng(1)
    tree, bins = packing.Tournament(100, 60), []
    for n in r.integers(1, 100, 60).tolist():
        fits = next((k for k, room in enumerate(bins) if room >= n), len(bins))
        if fits == len(bins):
            bins.append(100)
        assert tree.place(n) == (fits, bins[fits])
        bins[fits] -= n


def test_groups_are_first_fit_decreasing(corpus):
    """Every group of the packing, filled by a plain loop over bins."""
    rows = packing.pack(corpus, group=40).collect()
    groups = {}
    for r in rows:
        if r.length == packing.LENGTH:
            assert r.sequence_id < 0 and r.offset == 0
        else:
            groups.setdefault(r.sequence_id >> 32, []).append(r)
    assert len({r.sequence_id for r in rows if r.sequence_id < 0}) == sum(r.length == packing.LENGTH for r in rows) > 0
    assert len(groups) == -(-sum(map(len, groups.values())) // 40)
    for g, mine in groups.items():
        room, want = [], {}
        for r in sorted(mine, key=lambda r: (-r.length, r.doc_id, r.start)):
            k = next((k for k, left in enumerate(room) if left >= r.length), len(room))
            if k == len(room):
                room.append(packing.LENGTH)
            want[r.doc_id, r.start] = (g << 32) + k, packing.LENGTH - room[k]
            room[k] -= r.length
        assert {(r.doc_id, r.start): (r.sequence_id, r.offset) for r in mine} == want
    filled = sum(r.length for r in rows) / (packing.LENGTH * len({r.sequence_id for r in rows}))
    assert filled > 0.9


def test_copies_of_a_row_are_dealt_to_many_groups(spark):
    same = spark.createDataFrame([(7, "the same words again")] * 600, "doc_id long, text string").coalesce(1)
    rows = packing.pack(same, group=60).collect()
    groups = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 600 and len(groups) > 7 and max(groups.values()) < 120


def test_packing(tables, nothing, texts):
    lib = library(packing.VOCABULARY)
    for df in tables:
        rows = packing.pack(df).collect()
        whole = sorted((i is not None, i or 0, little([*lib(t), packing.END_ID])) for i, t in texts(df))
        found = sorted((r.doc_id is not None, r.doc_id or 0, r.start, bytes(r.ids)) for r in rows)
        assert sum(len(x[2]) for x in whole) == sum(len(x[3]) for x in found)
        assert {x[2][4 * r.start : 4 * (r.start + r.length)] for x in whole for r in rows if (r.doc_id is not None, r.doc_id or 0) == x[:2]} >= {x[3] for x in found}
        by = {}
        for r in rows:
            assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
            by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for v in by.values():
            at = 0
            for off, n in sorted(v):
                assert off == at
                at += n
            assert at <= packing.LENGTH
    assert packing.pack(nothing).collect() == []
