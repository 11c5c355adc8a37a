from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from hanji.llm import idcoder, tokens  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_round_trip_of_documents(docs, corpus_rows):
    got = sorted((tuple(r) for r in idcoder.round_trip(docs, PATH).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, *sorted(d for d, *_ in corpus_rows if d is not None)]
    by_id = {d: whole(t) for d, t, *_ in corpus_rows}
    start = 0
    for doc_id, at, n, crc in got:
        assert (at, n, crc) == (start, len(by_id[doc_id]), zlib.crc32(by_id[doc_id]))
        start += n


def test_no_rows(no_docs):
    assert idcoder.round_trip(no_docs, PATH).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_blocks_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 3000))
    ids = [rng.integers(0, 65536, n), np.full(n, 65535), np.zeros(n, int), rng.zipf(1.3, n) % 49408, np.arange(n) % 7, np.repeat(rng.integers(0, 300, n), 1)][seed].astype(np.int32)
    for block in (64, 500):
        prior = idcoder.Prior.unpack(idcoder.Prior.of(ids, block).pack())
        payloads = idcoder.encode_blocks(ids, idcoder.Prior.of(ids, block), block)
        assert (idcoder.decode_blocks(payloads, n, prior, block) == ids).all()
        # Every block stands for itself.
        assert (idcoder.decode_blocks(payloads[:1], min(block, n), prior, block) == ids[:block]).all()


def size(ids):
    written = idcoder.write_segment(ids)
    return len(written["prior"]) + sum(len(b["payload"]) for b in written["blocks"])


def test_repetition_compresses():
    ids = np.tile(np.random.default_rng(0).integers(0, 40_000, 64), 64).astype(np.int32)
    assert size(ids) < 0.3 * 2 * len(ids)


def test_fewer_bits_than_zlib_and_than_order_0(spark):
    """On the ids of made-up words of two vocabularies: fewer bytes than zlib makes of 16-bit ids, and fewer than the
    static order-0 entropy."""
    rng = random.Random(2)
    texts = []
    for k in range(300):
        syllables = ["the", "ing", "er", "and", "ou", "st"] if k % 2 else ["eau", "é", "tion", "que", "ais", "ille"]
        texts.append(" ".join("".join(rng.choices(syllables, (30, 20, 9, 5, 3, 1), k=rng.randint(1, 4))) for _ in range(400)))
    ids = np.concatenate(tokens.PieceEncoder(PATH, "word").encode(texts)).astype(np.int32)
    shares = np.bincount(ids) / len(ids)
    entropy = -(shares[shares > 0] * np.log2(shares[shares > 0])).sum()
    bits = size(ids) * 8 / len(ids)
    assert bits < entropy and bits < 0.9 * 8 * len(zlib.compress(ids.astype("<u2").tobytes(), 9)) / len(ids)


def test_one_block_length_at_every_size():
    for n in (100, 10_000, 70_000):
        lengths = [b["n_ids"] for b in idcoder.write_segment(np.arange(n) % 300)["blocks"]]
        assert set(lengths[:-1]) <= {idcoder.BLOCK_IDS} and sum(lengths) == n
    with pytest.raises(ValueError):
        idcoder.write_segment(np.array([1, 1 << 16]))


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.int32) % 977
    written = idcoder.write_segment(ids)
    prior, blocks = written["prior"], written["blocks"]
    assert (idcoder.read_segment(5000, prior, blocks) == ids).all()
    broken = bytearray(blocks[1]["payload"])
    broken[10] ^= 0xFF
    blocks[1]["payload"] = bytes(broken)
    with pytest.raises(idcoder.DamagedBlock):
        idcoder.read_segment(5000, prior, blocks)


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_pieces_give_the_tokenizers_ids(name, kind, monkeypatch):
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\x00", "\x1c", "\x85", "\xa0", "　", "a", "b'", "'s", "don't", "É", "é", "한국", "1", "23", ".", "...", ",", "!", "<|endoftext|>", "😀", "İ", "ß", "\r\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", " ", "\n", "x" * 200, " long" * 300]
    encoder = tokens.PieceEncoder(public_tokenizers.path(name), kind)
    monkeypatch.setattr(tokens, "CACHE_PIECES", 2000)  # both generations turn over
    for at in range(0, len(texts), 250):
        part = texts[at : at + 250]
        want = encoder.tokenizer.encode_batch(part, add_special_tokens=False)
        assert [g.tolist() for g in encoder.encode(part)] == [e.ids for e in want]


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_words_are_looked_up_once_and_marks_apart(name, kind):
    """However often a word stands in a batch and whatever marks follow it, it is encoded once."""
    encoder = tokens.PieceEncoder(public_tokenizers.path(name), kind)
    asked = []
    encoder.encoded = lambda keys, own=encoder.encoded: (asked.extend(keys), own(keys))[1]
    texts = ["start", *[f"start über{m} gone{m}\nüber{m} Gone" for m in ("", "***", "&&&", "...", "?!", ",")]]
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in encoder.encode(texts)] == [e.ids for e in want]
    assert len(asked) == len(set(asked)) and {k.strip("\x00\n") for k in asked} == {"start", "über", "gone", "Gone"}


@pytest.mark.parametrize(("name", "kind"), [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")])
def test_new_words_reach_the_model_many_in_a_string(name, kind):
    encoder = tokens.PieceEncoder(public_tokenizers.path(name), kind)
    rng = random.Random(4)
    texts = [rng.choice([" ", "\n"]).join("".join(rng.choices(["The", "ing", "er", "é", "ß", "ou", "Ž"], k=rng.randint(1, 6))) for _ in range(300)) for _ in range(20)]
    texts += ["", " ", " a", "\ta b", "a\t b", "a \tb", "a\n\tb", "a \x00b", "\x00b a", "a  b", "a b ", "a\n", "a\nb\x1cc", "aİ b", "a\n\n b"]
    strings = []

    class Counted:
        def encode_batch_fast(self, groups, own=encoder.words, **options):
            strings.extend(groups)
            return own.encode_batch_fast(groups, **options)

    encoder.words = Counted()
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    for _ in range(2):
        assert [g.tolist() for g in encoder.encode(texts)] == [e.ids for e in want]
    words = sum(len(s.split(" ")) for s in strings)
    assert words > 2000 and len(strings) <= words / tokens.GROUP + 3


@pytest.mark.parametrize("ids", [np.zeros(5001, int), np.arange(9000) % 3, np.arange(70_000) % 65536, np.r_[np.zeros(999, int), np.tile([65535, 65535, 7], 900)], np.arange(5), np.array([9])], ids=str)
def test_common_pairs_are_one_symbol(ids):
    """From left to right within blocks, with what overlaps, and back; a segment without free ids has no such pairs."""
    joins = idcoder.Joins.of(ids)
    for block in (7, 500, 2048):
        symbols, lengths = joins.join(ids, block)
        parted, n = joins.part(symbols, lengths)
        assert (parted == ids).all() and n.tolist() == [len(ids[s : s + block]) for s in range(0, len(ids), block)]
        pairs = set(joins.pairs.tolist())
        for k in range(0, len(ids), max(block, 1500) // block * block):
            part, want, at = ids[k : k + block].tolist(), 0, 0
            while at < len(part):
                at += 2 if at + 1 < len(part) and part[at] << 16 | part[at + 1] in pairs else 1
                want += 1
            assert lengths[k // block] == want
    assert len(np.unique(ids)) < idcoder.IDS or not len(joins.pairs)
    written = idcoder.write_segment(ids)
    assert (idcoder.read_segment(len(ids), written["prior"], written["blocks"]) == ids).all()


def test_the_coder_takes_fewer_steps_than_a_block_has_ids(monkeypatch):
    ids, steps = np.random.default_rng(1).choice(8, 20_000) * 2 + np.arange(20_000) % 2 * 100, []
    monkeypatch.setattr(idcoder.Model, "predict", lambda self, n, own=idcoder.Model.predict: (steps.append(n), own(self, n))[1])
    written = idcoder.write_segment(ids)
    assert (idcoder.read_segment(len(ids), written["prior"], written["blocks"]) == ids).all()
    assert 0 < sum(steps) < 0.7 * 2 * len(ids)
    for at in (0, 1):  # the number of a block's symbols
        blocks = [dict(b) for b in written["blocks"]]
        blocks[3]["payload"] = blocks[3]["payload"][:at] + bytes([blocks[3]["payload"][at] ^ 0x55]) + blocks[3]["payload"][at + 1 :]
        with pytest.raises(idcoder.DamagedBlock):
            idcoder.read_segment(len(ids), written["prior"], blocks)


def test_words_of_letters_stay_columns(monkeypatch):
    """They aren't looked up one by one as Python strings; the table of short words may have far too few places, hold
    words of any length up to its own, and keep none that have more ids than it has room for."""
    monkeypatch.setattr(tokens.ShortWords, "SLOT_BITS", 6)
    encoder = tokens.PieceEncoder(PATH, "word")
    rng = random.Random(5)
    letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
    words = ["".join(rng.choices(letters, k=n)) for n in range(1, 40) for _ in range(20)] + [*letters, *("Ab" * n for n in range(1, 20))]
    texts = ["", "\n", "?!", "".join(letters), *(" ".join(rng.choice(words) + rng.choice(["", "", ",", "...", "'s", "_"]) for _ in range(60)) for _ in range(80))]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    seen = []
    monkeypatch.setattr(encoder, "seen", lambda keys, own=encoder.seen: (seen.extend(keys), own(keys))[1])
    for _ in range(3):
        for at in range(0, len(texts), 30):
            assert [g.tolist() for g in encoder.encode(texts[at : at + 30])] == want[at : at + 30]
    plain = {c for c in letters if len(c.lower().encode()) == len(c.encode())}
    assert seen and not [k for k in seen if k.rstrip(",.") and set(k.rstrip(",.")) <= plain]


def test_a_damaged_end_reads_no_further_than_the_payloads():
    ids = np.arange(5000, dtype=np.int32) % 977
    written = idcoder.write_segment(ids)
    for block in written["blocks"]:
        damaged = [dict(b, payload=b["payload"][:7]) if b is block else b for b in written["blocks"]]
        with pytest.raises(idcoder.DamagedBlock):
            idcoder.read_segment(5000, written["prior"], damaged)
