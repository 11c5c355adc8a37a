"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once for a Python worker."""

from __future__ import annotations

import ctypes
import gc
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, compress
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bounds on what a worker holds: bytes of texts at once, the same where they become ids, pieces in each of the cache's two generations, and
#: characters of a piece in the cache; and pieces and words that the tokenizer gets in one string.
BATCH_CHARS, ENCODE_CHARS, CACHE_PIECES, PIECE_CHARS, JOINED, GROUP = 2_000_000, 3_000_000, 500_000, 48, 500, 50
#: Bytes of a long text that are cut into words at once.
SLICE_BYTES = 1 << 20

#: A byte-level BPE with GPT-2's pattern always starts a new word at a space or line feed that anything but white space
#: follows, and words are encoded one by one; so texts may be cut there, and pieces that begin so may be joined.
SPACED = re.compile(r"[ \n]?(?:[^ \n]+|[ \n](?!\S))+")
#: Letters and line feeds: Latin ones, of which none becomes two in lower case.
LATIN = re.compile("[\x00-įı-ɏ]+")
#: Latin letters that take as many bytes in lower case; and pairs of bytes, as numbers, to those of the lower case.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower().encode()) == len(c.encode()))
LOWER = np.arange(1 << 16, dtype=np.uint16)
LOWER[[int.from_bytes(c.encode()) for c in LETTERS if c > "\x7f"]] = [int.from_bytes(c.lower().encode()) for c in LETTERS if c > "\x7f"]
#: Marks that are words of their own after a letter, alone or in a row (an apostrophe may begin one with letters, and a
#: low line counts as a letter for some tokenizers).
MARKS = "".join(sorted(set(punctuation) - set("'_")))

#: The characters by which byte-level tokenizers name bytes: printable ones of Latin-1 name themselves, the others take
#: the code points from 256 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_NAMES = {b: b if b in PRINTABLE else 256 + sum(x not in PRINTABLE for x in range(b)) for b in range(256)}

#: The same for words with a line feed between them, which becomes a space.
WORD_NAMES = np.array([32 if b == 10 else BYTE_NAMES[b] for b in range(256)], "<u2")


def strings_of(pieces: pa.LargeStringArray) -> list[str]:
    """A column of pieces without spaces as a list."""
    count = len(pieces)
    return pc.binary_join(pa.LargeListArray.from_arrays([0, count], pieces), pa.scalar(" ", pa.large_string()))[0].as_py().split(" ") if count else []


def in_lower_case(data: np.ndarray) -> np.ndarray:
    """UTF-8 of LETTERS and line feeds."""
    data = np.frombuffer(data.tobytes().lower(), np.uint8).copy()
    lead = np.flatnonzero(data >= 0xC0)
    pair = LOWER[data[lead].astype(np.uint16) << 8 | data[lead + 1]]
    data[lead], data[lead + 1] = pair >> 8, pair & 0xFF
    return data


class ShortWords:
    """Ids of short words that a worker has met, for columns of them. The table has one row for each hash, which a word
    takes from the one before: its bytes (none of them 0), the number of its ids, and those."""

    SLOT_BITS, KEY, IDS = 20, 3, 16
    MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.table = np.zeros((1 << self.SLOT_BITS, self.KEY + 1 + self.IDS * dtype.itemsize // 8), np.uint64)

    def keys(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, slots) of the words, of which one with more than 8 * KEY bytes has a key that no other has."""
        bounds = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, words.offset * 8)
        data = np.frombuffer((words.buffers()[2] or pa.py_buffer(b"")).to_pybytes() + bytes(8 * self.KEY), np.uint8)
        eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        size, keys = np.diff(bounds), np.empty((len(words), self.KEY), np.uint64)
        for k in range(self.KEY):
            keys[:, k] = eights[np.minimum(bounds[:-1] + 8 * k, len(eights) - 1)] & self.MASKS[np.clip(size - 8 * k, 0, 8)]
        keys[size > 8 * self.KEY] = 0  # rows of the table that hold nothing count no ids
        h = keys[:, 0] ^ keys[:, 1] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 2] * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return keys, (h >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)

    def encode(self, words: pa.LargeStringArray, encoded: Callable[[list[str]], list[bytes]]) -> pa.LargeBinaryArray:
        """The words' ids, by `encoded` if they aren't in the table."""
        keys, slots = self.keys(words)
        rows = self.table[slots]
        known = (rows[:, : self.KEY] == keys).all(axis=1) & (keys[:, 0] != 0)
        new = encoded(strings_of(words.filter(pa.array(~known))))
        ids, size = rows[known, self.KEY + 1 :].view(self.dtype), rows[known, self.KEY].astype(np.int64)
        ends = np.r_[0, np.cumsum(size * self.dtype.itemsize)]
        of_known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(ids[np.arange(self.IDS) < size[:, None]])])
        self.keep(keys[~known], slots[~known], new)
        return in_place(known, of_known, pa.array(new, pa.large_binary()))

    def keep(self, keys: np.ndarray, slots: np.ndarray, values: list[bytes]) -> None:
        size = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        fit = (keys[:, 0] != 0) & (size <= self.IDS)
        rows = np.zeros((fit.sum(), self.table.shape[1]), np.uint64)
        rows[:, : self.KEY], rows[:, self.KEY] = keys[fit], size[fit]
        ids = np.zeros((len(rows), self.IDS), self.dtype)
        ids[np.arange(self.IDS) < size[fit, None]] = np.frombuffer(b"".join(compress(values, fit.tolist())), self.dtype)
        rows[:, self.KEY + 1 :] = ids.view(np.uint64)
        self.table[slots[fit]] = rows  # of rows with one slot, a whole one stays


def in_place(chosen: np.ndarray, some: pa.Array, others: pa.Array) -> pa.Array:
    """One column of `some`, where `chosen`, and others, each in order."""
    place = np.where(chosen, np.cumsum(chosen) - 1, len(some) + np.cumsum(~chosen) - 1)
    return pa.concat_arrays([some, others]).take(pa.array(place))


class PieceEncoder:
    """Texts -> ids. kind `word`: the tokenizer drops white space, texts are cut at space and line feed; kind `byte`:
    texts are cut before them. Strings that look like special tokens are ordinary text.

    Pieces are known by keys. For `byte` the key of a piece that begins with a space is what follows it; with a line
    feed, the piece itself; any other piece has a zero character before it and is never joined with others.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # The same model for words that have been through the tokenizer's first steps, a space between them.
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() < 1 << 16 else "<u4")
        #: Characters (that name bytes) of each id.
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.sizes[number] = len(token.removesuffix("</w>") if kind == "word" else token)
        self.kind = kind
        self.short = ShortWords(self.dtype) if kind == "word" else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.line_feed = self.raw(["\n"])[0] if kind == "byte" else b""

    @staticmethod
    def begins(key: str) -> bool:
        """Whether a text may be cut before this key: it is the text's first, or anything but white space follows the
        space or line feed."""
        first = key[1:2] if key[:1] == "\n" else key[:1]
        return key[:1] == "\x00" or first != "" and not first.isspace()

    @staticmethod
    def key(piece: str) -> str:
        if len(piece) > 1 and piece[0] in " \n" and not piece[1].isspace() and piece[1] != "\x00":
            return piece if piece[0] == "\n" else piece[1:]
        return "\x00" + piece

    def piece(self, key: str) -> str:
        if self.kind == "word" or key[0] == "\n":
            return key
        return key[1:] if key[0] == "\x00" else " " + key

    def raw(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def joined(self, pieces: list[str]) -> Iterator[bytes]:
        """As raw, with many pieces in a string: an id belongs to the piece in which its characters end."""
        between = " " if self.kind == "word" else ""
        groups = [pieces[at : at + JOINED] for at in range(0, len(pieces), JOINED)]
        for group, e in zip(groups, self.tokenizer.encode_batch([between.join(g) for g in groups], add_special_tokens=False), strict=True):
            ends = np.cumsum([len(p) + len(between) for p in group]) - len(between)
            upto = np.searchsorted(np.array([end for _, end in e.offsets]), ends, side="right") * self.dtype.itemsize
            ids, start = np.array(e.ids, self.dtype).tobytes(), 0
            for end in upto.tolist():
                yield ids[start:end]
                start = end

    def of_words(self, words: list[str]) -> list[bytes]:
        """Words of LETTERS (for `byte` with a space before those that have one), many in a string, as the tokenizer's own
        first steps would hand them to the model: they never cut between letters. An id belongs to the word in which its
        characters end; all bytes have an id, so the lengths of ids add up to those of words."""
        data = np.frombuffer("\n".join(words).encode(), np.uint8)
        if self.kind == "word":
            data = in_lower_case(data)
        text = WORD_NAMES[data].tobytes().decode("utf-16-le")
        ends = np.append(np.flatnonzero(data == 10), len(data))
        last = np.append(ends[GROUP - 1 : -1 : GROUP], len(data)).tolist()
        groups = [text[s:e] for s, e in zip([0, *(e + 1 for e in last)], last, strict=False)]
        # Few groups at once: an encoding takes far more room than its ids.
        parts = (self.words.encode_batch_fast(groups[at : at + GROUP], add_special_tokens=False) for at in range(0, len(groups), GROUP))
        ids = np.fromiter(chain.from_iterable(e.ids for part in parts for e in part), self.dtype)
        ends -= np.arange(len(ends))
        upto = np.cumsum(self.sizes[ids])
        if len(ids) == 0 or upto[-1] != ends[-1]:
            raise ValueError("the tokenizer has no ids for some bytes")
        at = ((np.searchsorted(upto, ends) + 1) * self.dtype.itemsize).tolist()
        data = ids.tobytes()
        return [data[s:e] for s, e in zip([0, *at[:-1]], at, strict=True)]

    def joined_all(self, pieces: list[str]) -> Iterator[bytes]:
        for at in range(0, len(pieces), 20 * JOINED):
            yield from self.joined(pieces[at : at + 20 * JOINED])

    def encoded(self, keys: list[str]) -> list[bytes]:
        if self.kind == "word":
            latin = keys and not pc.utf8_ltrim(pa.scalar("".join(keys), pa.large_string()), LETTERS).as_py()
            return self.of_words(keys) if latin else list(self.joined_all(keys))
        ascii, latin, after_feed, others = [], [], [], []
        for k in keys:
            if k.isalpha():
                (ascii if k.isascii() else latin if LATIN.fullmatch(k) else others).append(k)
            elif k[0] == "\n" and k[1:].isalpha() and LATIN.fullmatch(k):
                after_feed.append(k)
            else:
                others.append(k)
        out = {}
        for part in ascii, latin:
            if part:
                out.update(zip(part, self.of_words([" " + k for k in part]), strict=True))
        if after_feed:
            out.update((k, self.line_feed + ids) for k, ids in zip(after_feed, self.of_words([k[1:] for k in after_feed]), strict=True))
        alone = [k for k in others if k[0] == "\x00"]
        others = [k for k in others if k[0] != "\x00"]
        out.update(zip(alone, self.raw([self.piece(k) for k in alone]), strict=True))
        out.update(zip(others, self.joined_all([self.piece(k) for k in others]), strict=True))
        return [out[k] for k in keys]

    def learn(self, keys: list[str]) -> None:
        """Encode new pieces. Marks at the end are a word of their own after a Latin letter that stays one letter in
        lower case."""
        known, stems, ask = self.known, {}, []
        for k in keys:
            if k[-1] in MARKS:
                stem = k.rstrip(MARKS)
                if len(stem) > 1 and stem[-1].isalpha() and stem[-1] < "ɐ" and stem[-1] != "İ":
                    stems[k] = stem
                    continue
            ask.append(k)
        asked = dict.fromkeys(ask)
        asked.update((stem, None) for stem in stems.values() if stem not in known)
        known.update(zip(asked, self.encoded(list(asked)), strict=True))
        marks = list({k[len(stem) :] for k, stem in stems.items()})
        of_marks = dict(zip(marks, self.raw(marks), strict=True))
        known.update((k, known[stem] + of_marks[k[len(stem) :]]) for k, stem in stems.items())

    def seen(self, keys: list[str]) -> tuple[list[bytes | None], list[int]]:
        """Each distinct key's ids, as far as they are known, and the places of the others."""
        values = list(map(self.known.get, keys))
        gone = [k for k, v in enumerate(values) if v is None]
        if len(self.known) + len(gone) > CACHE_PIECES:  # what is still in use goes to the new generation
            self.known, self.older = {k: v for k, v in zip(keys, values, strict=True) if v is not None}, self.known
        known, older, new = self.known, self.older, []
        for k in gone:
            key = keys[k]
            ids = older.get(key)
            if ids is None:
                new.append(k)
            else:
                values[k] = known[key] = ids
        return values, new

    def fill(self, keys: list[str], values: list[bytes | None], new: list[int]) -> None:
        """The ids at the places `new`, learned but for those of long pieces. An empty key has none."""
        long = [keys[k] for k in new if len(keys[k]) > PIECE_CHARS]
        found = dict(zip(long, self.raw([self.piece(k) for k in long]), strict=True)) | {"": b""}
        self.learn([keys[k] for k in new if keys[k] not in found])
        known = self.known
        for k in new:
            key = keys[k]
            values[k] = found[key] if key in found else known[key]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids. There are no cycles among the very many strings here, so none are looked for meanwhile."""
        collects = gc.isenabled()
        gc.disable()
        try:
            return self.ids_of_words(texts) if self.kind == "word" else self.ids_of(texts)
        finally:
            if collects:
                gc.enable()

    def ids_of_words(self, texts: list[str]) -> list[np.ndarray]:
        """Pieces of letters, with or without marks at the end, stay columns from text to ids; others are looked up."""
        pieces = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
        numbered = pieces.flatten().dictionary_encode()
        distinct = numbered.dictionary
        marks = pc.utf8_ltrim(distinct, LETTERS)
        size, of_marks = pc.binary_length(distinct), pc.binary_length(marks)
        plain = pc.and_(pc.less(of_marks, size), pc.equal(pc.binary_length(pc.utf8_trim(marks, MARKS)), 0))
        words = pc.utf8_rtrim(distinct.filter(plain), MARKS).dictionary_encode()
        of_words = self.short.encode(words.dictionary, self.encoded).take(words.indices)
        marks = marks.filter(plain).dictionary_encode()
        of_marks = pa.array(self.raw(marks.dictionary.to_pylist()), pa.large_binary()).take(marks.indices)
        keys = strings_of(distinct.filter(pc.invert(plain)))
        values, new = self.seen(keys)
        self.fill(keys, values, new)
        of_words = pc.binary_join_element_wise(of_words, of_marks, pa.scalar(b"", pa.large_binary()))
        ids = in_place(plain.to_numpy(zero_copy_only=False), of_words, pa.array(values, pa.large_binary())).take(numbered.indices)
        data = np.frombuffer(ids.buffers()[2] or b"", self.dtype)
        bounds = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8)[pieces.offsets.to_numpy()] // self.dtype.itemsize
        return [data[s:e] for s, e in zip(bounds[:-1], bounds[1:], strict=True)]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """Pieces are cut and numbered as columns, and only distinct ones are looked up."""
        if not texts:
            return []
        at = [k for k, t in enumerate(texts) if "\x00" not in t]
        cut = ["\x00" + texts[k].replace("\n", " \n") for k in at]
        pieces = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        numbered = pieces.flatten().dictionary_encode()
        number, first = numbered.indices.to_numpy(), pieces.offsets.to_numpy()
        count = len(numbered.dictionary)
        keys = strings_of(numbered.dictionary)
        del cut, pieces, numbered  # new pieces take room of their own
        values, new = self.seen(keys)
        unfit = [k for k in new if not self.begins(keys[k])]
        apart = set(range(len(texts))).difference(at)
        if unfit:
            fit = np.ones(count, bool)
            fit[unfit] = False
            apart.update(np.array(at)[~np.logical_and.reduceat(fit[number], first[:-1])].tolist())
            for k in unfit:
                keys[k] = ""
        others = {k: [self.key(p) for p in SPACED.findall(texts[k])] for k in apart}
        if others:
            more = list(set().union(*others.values()).difference(keys))
            of_more, new_more = self.seen(more)
            keys, values, new = keys + more, values + of_more, new + [count + k for k in new_more]
        self.fill(keys, values, new)
        of_others = dict(zip(keys, values, strict=True)) if others else {}
        del values[count:]
        sizes = np.fromiter(map(len, values), np.int32, len(values)) // self.dtype.itemsize
        taken = sizes[number]
        ends = np.zeros(len(taken) + 1, np.int64)
        np.cumsum(taken, out=ends[1:])
        place = np.int32 if max(ends[-1], sizes.sum()) < 1 << 31 else np.int64  # the largest columns here: one place for each id
        source = np.repeat((np.cumsum(sizes, dtype=np.int64) - sizes).astype(place)[number] - ends[:-1].astype(place), taken)
        source += np.arange(ends[-1], dtype=place)
        ids, bounds = np.frombuffer(b"".join(values), self.dtype)[source], ends[first]
        found = {k: ids[s:e] for k, s, e in zip(at, bounds[:-1], bounds[1:], strict=True)}
        found |= {k: np.frombuffer(b"".join(map(of_others.__getitem__, c)), self.dtype) for k, c in others.items()}
        return [found[k] for k in range(len(texts))]


_encoders: dict[tuple[str, str], PieceEncoder] = {}


def encoder(path: str, kind: str) -> PieceEncoder:
    """One encoder for a worker, kept between tasks. Spark runs a task for each core, so the library gets one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, kind) not in _encoders:
        _encoders[path, kind] = PieceEncoder(path, kind)
    return _encoders[path, kind]


def give_back() -> None:
    """Return what is free to the system. A worker lives on after its task, beside others and the executor, and keeps the
    most memory that any task took: after millions of short strings that is twice what it holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def slices(text: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in parts of about `size` bytes, cut at spaces."""
    start = 0
    while len(text) - start > size and (end := text.find(b" ", start + size)) >= 0:
        yield text[start:end]
        start = end
    yield text[start:]


def portions(batch: pa.RecordBatch, column: str = "text", chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, in portions of about `chars` bytes of text (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // chars
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
    for s, e in zip(starts, [*starts[1:], len(part)], strict=True):
        yield batch.slice(s, e - s)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]
