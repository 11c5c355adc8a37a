"""Phrases whose words stand together more often than chance, counted by suffix arrays over word ids."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import HOT_KEYS, in_order, join_hot, staged

#: Words of the longest phrase, occurrences that a candidate needs, percentage of them at which a longer phrase drops it,
#: and phrases that a language's list has.
LONGEST, LEAST, SHARE, TOP = 5, 100, 100, 2000
#: Words of a shard, bits of a filter for each phrase in it, the most bits that a filter may have, those of its slices, and its hashes.
SHARD_WORDS, FILTER_BITS, MOST_BITS, SLICE_BITS, PROBES = 1 << 20, 16, 1 << 28, 1 << 20, 3
#: Phrases that a worker puts into one batch.
BATCH_ROWS = 1 << 16
#: Parts into which the pairs that begin with a hot word are dealt.
SLOTS = 64
#: Marks that end a piece, and the byte that stands for them, which UTF-8 never has.
MARKS, BREAK = ".,;:!?\n\x0b\x0c\r", b"\xff"
CUT = bytes.maketrans((ascii_uppercase + MARKS + "\t").encode(), ascii_lowercase.encode() + BREAK * len(MARKS) + b" ")


@dataclass
class Shard:
    """Word ids in order, 0 between pieces; ids of different languages differ. Phrases may begin before `upto`."""

    langs: list[str] = field(default_factory=list)
    words: list[bytes] = field(default_factory=list)
    lang_of: list[int] = field(default_factory=list)
    parts: list[np.ndarray] = field(default_factory=list)
    size: int = 0
    upto: int = 0

    def __post_init__(self) -> None:
        self.known: dict[str, _Ids] = {}
        self.words.append(b"")  # id 0
        self.lang_of.append(-1)

    def ids_of(self, lang: str, words: list[bytes]) -> np.ndarray:
        if lang not in self.known:
            number = len(self.langs)
            self.langs.append(lang)
            self.known[lang] = _Ids(self.words, self.lang_of, number)
        return np.fromiter(map(self.known[lang].__getitem__, words), np.int32, len(words))

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.size += len(ids)

    def ids(self) -> np.ndarray:
        return np.concatenate([*self.parts, np.zeros(LONGEST, np.int32)])


class _Ids(dict):
    """word -> id, given when first asked for. It knows the shard's lists and not the shard: objects that know each other
    stay until Python looks for such rings, which it seldom does where there are few."""

    def __init__(self, words: list[bytes], lang_of: list[int], lang: int):
        super().__init__({BREAK: 0})
        self.words, self.lang_of, self.lang = words, lang_of, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.lang_of.append(self.lang)
        return number


def shards(batches: Iterator[pa.RecordBatch], longest: int, shard_words: int) -> Iterator[Shard]:
    """Rows (text, lang) -> shards of about shard_words words. A text may go on in the next shard, which then begins with
    the words that phrases across the cut need; those phrases belong to the shard in which they begin.

    A shard's memory goes back to the system before the next is filled, if whoever took it has let go of it by then."""
    shard = Shard()
    for batch in batches:
        for part in tokens.portions(batch):
            for text, lang in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("lang").to_pylist(), strict=True):
                lang = "und" if lang is None else lang
                for piece in tokens.slices((text or b"").translate(CUT).replace(BREAK, b" \xff ")):
                    if shard.size >= shard_words:
                        ids = shard.ids()[: shard.size]
                        tail = [shard.words[i] or BREAK for i in ids[max(0, len(ids) - longest + 1) :].tolist()]
                        shard.upto = shard.size - len(tail)
                        yield shard
                        del shard, ids
                        tokens.give_back()
                        shard = Shard()
                        shard.add(shard.ids_of(lang, tail))
                    shard.add(shard.ids_of(lang, piece.split()))
                shard.add(np.zeros(1, np.int32))
                if shard.size >= shard_words:
                    shard.upto = shard.size
                    yield shard
                    del shard
                    tokens.give_back()
                    shard = Shard()
    shard.upto = shard.size
    yield shard
    del shard
    tokens.give_back()


def batch_of(shard: Shard, langs: np.ndarray, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """One key for language and phrase, with a tab between, which no phrase has."""
    names = pa.array(shard.langs, pa.string()).take(pa.array(langs))
    return pa.RecordBatch.from_arrays([pc.binary_join_element_wise(names, phrases, "\t"), pa.array(counts.astype(np.int64))], ["key", "count"])


def _words(shard_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of single words; under an empty phrase, all words of the language."""
    for shard in shards(batches, 1, shard_words):
        yield from _words_of(shard)
        del shard


def _words_of(shard: Shard) -> Iterator[pa.RecordBatch]:
    counts = np.bincount(shard.ids()[: shard.upto], minlength=len(shard.words))[1:]
    langs = np.array(shard.lang_of[1:], np.int64)
    if len(counts):
        counted = np.flatnonzero(counts)
        words = pa.array(shard.words[1:], pa.binary()).cast(pa.string())
        for at in range(0, len(counted), BATCH_ROWS):
            some = counted[at : at + BATCH_ROWS]
            yield batch_of(shard, langs[some], words.take(pa.array(some)), counts[some])
        totals = np.bincount(langs, weights=counts, minlength=len(shard.langs)).astype(np.int64)
        some = np.flatnonzero(totals)
        yield batch_of(shard, some, pa.array([""] * len(some), pa.string()), totals[some])


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def slice_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The slice of a filter of so many bits that has all of a hash's places."""
    return hashes >> np.uint64(44) & np.uint64(max(1, bits // SLICE_BITS) - 1)


def places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    start, inside = slice_of(hashes, bits) * np.uint64(SLICE_BITS), np.uint64(min(bits, SLICE_BITS) - 1)
    for k in range(PROBES):
        yield start + ((hashes + np.uint64(k) * (hashes >> np.uint64(24) | np.uint64(1))) & inside)


class Filter:
    """A Bloom filter: what was put in is found, and little else as long as there are bits enough."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for at in places(hashes, 8 * len(self.data)):
            found &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def word_hashes(words: list[bytes], langs: list[str]) -> np.ndarray:
    seeds = {lang: xxhash.xxh64_intdigest(lang.encode()) for lang in set(langs)}
    return np.fromiter((xxhash.xxh64_intdigest(w, seeds[lang]) for w, lang in zip(words, langs, strict=True)), np.uint64, len(words))


def _filter_hashes(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases -> their hashes and the slices that these go to."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        words = [p.encode().split(b" ") for p in batch.column("phrase").to_pylist()]
        if words:
            first, *rest = (word_hashes(list(w), langs) for w in zip(*words, strict=True))
            hashes = mixed(first, rest[0]) if rest else first
            yield pa.RecordBatch.from_arrays([pa.array(slice_of(hashes, bits).astype(np.int32)), pa.array(hashes.view(np.int64))], ["slice", "hash"])
    tokens.give_back()


def _filter_slices(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, hash) in order of slices -> each slice's bytes."""
    made = lambda at, data: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([data.tobytes()], pa.binary())], ["slice", "bits"])
    at, data = None, None
    for batch in batches:
        slices, hashes = batch.column("slice").to_numpy(), batch.column("hash").to_numpy().view(np.uint64)
        starts = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]) if len(slices) else []
        for s, e in zip(starts, [*starts[1:], len(slices)], strict=True):
            if at != slices[s]:
                if data is not None:
                    yield made(at, data)
                at, data = int(slices[s]), np.zeros(min(bits, SLICE_BITS) // 8, np.uint8)
            for place in places(hashes[s:e], bits):
                place = place - np.uint64(at * SLICE_BITS)
                np.bitwise_or.at(data, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    if data is not None:
        yield made(at, data)


def filter_of(phrases: DataFrame, most_bits: int) -> Broadcast:
    """Stored phrases (lang, phrase), all single words or all pairs -> a broadcast Filter that has them.

    FILTER_BITS bits for each phrase, but most_bits in all: beyond that the filter lets more through and loses nothing. A
    task makes one slice after the other, from the hashes that fall into it, so none holds the whole; the driver puts them
    together.
    """
    bits = min(most_bits, 1 << max(10, (FILTER_BITS * phrases.count() - 1).bit_length()))
    hashes = phrases.select("lang", "phrase").mapInArrow(partial(_filter_hashes, bits), "slice int, hash long")
    parts = hashes.repartition("slice").sortWithinPartitions("slice").mapInArrow(partial(_filter_slices, bits), "slice int, bits binary")
    data, size = np.zeros(bits // 8, np.uint8), min(bits, SLICE_BITS) // 8
    for row in parts.collect():
        data[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(Filter(data))


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ids in the order of the `depth` ids that begin there (as if zeros followed the last), by prefix
    doubling: ranks of the first h ids, and of the h behind them, give those of 2h."""
    rank, h = ids.astype(np.int64), 1
    while True:
        behind = np.zeros(len(rank), np.int64)
        behind[:-h] = rank[h:]
        if h >= depth:
            return np.argsort(rank, kind="stable")
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + behind, return_inverse=True)[1] + 1
        h *= 2


def common_prefixes(ids: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each suffix in order, how many ids it has in common with the one before it, `most` at most."""
    lcp, same = np.zeros(len(order), np.int8), np.ones(max(0, len(order) - 1), bool)
    for j in range(most):
        at = ids[order + j]
        same &= at[1:] == at[:-1]
        lcp[1:] += same
    return lcp


def phrase_counts(ids: np.ndarray, pairs: np.ndarray, upto: int, shortest: int, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids with `longest` zeros at the end, whether position and next may stand in a phrase -> for each length the ids of
    its phrases (a row each) and their counts. A phrase is an interval of the suffix array within which neighbours share
    that many ids."""
    reach = (ids != 0).astype(np.int8)  # how many words a phrase that begins here can have
    ok = pairs
    for _ in range(2, longest + 1):
        reach += ok
        ok = pairs & np.r_[ok[1:], False]
    begins = reach >= shortest
    begins[upto:] = False
    # Only what lies in a phrase is sorted, with a zero behind each stretch.
    covered = np.zeros(len(ids), bool)
    for j in range(longest):
        covered[j:] |= (begins & (reach > j))[: len(ids) - j]
    kept = covered | np.r_[False, covered[:-1]]
    ids, reach, begins = np.where(covered, ids, 0)[kept], reach[kept], begins[kept]
    if not len(ids):
        return
    ids = np.r_[ids, np.zeros(longest, ids.dtype)]
    order = suffix_array(ids, longest)
    order = order[np.r_[begins, np.zeros(longest, bool)][order]]
    lcp = common_prefixes(ids, order, longest)
    for length in range(shortest, longest + 1):
        heads = np.flatnonzero(lcp < length)
        counts = np.diff(np.r_[heads, len(order)])
        some = reach[order[heads]] >= length
        yield ids[order[heads[some]][:, None] + np.arange(length)], counts[some]


def _linked(longest: int, words: Broadcast, pairs: Broadcast | None, shard_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Shard, np.ndarray, np.ndarray, np.ndarray]]:
    """Shards with their words' hashes, their ids (0 for infrequent words) and whether position and next may stand in a
    phrase."""
    for shard in shards(batches, longest, shard_words):
        if len(shard.words) < 2:
            del shard
            continue
        hashes = np.r_[np.uint64(0), word_hashes(shard.words[1:], [shard.langs[i] for i in shard.lang_of[1:]])]
        frequent = words.value.has(hashes)
        frequent[0] = False
        ids = shard.ids()
        ids[~frequent[ids]] = 0
        both = np.r_[(ids[:-1] != 0) & (ids[1:] != 0), False]
        if pairs is not None:
            at = np.flatnonzero(both)
            both[at] = pairs.value.has(mixed(hashes[ids[at]], hashes[ids[at + 1]]))
        yield shard, hashes, ids, both
        del shard, hashes, frequent, ids, both


def _phrases(shortest: int, longest: int, words: Broadcast, pairs: Broadcast | None, shard_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, hashes, ids, both in _linked(longest, words, pairs, shard_words, batches):
        yield from _phrases_of(shard, ids, both, shortest, longest)
        del shard, hashes, ids, both


def _phrases_of(shard: Shard, ids: np.ndarray, both: np.ndarray, shortest: int, longest: int) -> Iterator[pa.RecordBatch]:
    names, lang_of = pa.array(shard.words, pa.binary()).cast(pa.string()), np.array(shard.lang_of, np.int64)
    for found, counts in phrase_counts(ids, both, shard.upto, shortest, longest):
        for at in range(0, len(counts), BATCH_ROWS):
            some = found[at : at + BATCH_ROWS]
            columns = [names.take(pa.array(column)) for column in some.T]
            yield batch_of(shard, lang_of[some[:, 0]], pc.binary_join_element_wise(*columns, " "), counts[at : at + BATCH_ROWS])


STRIPE = "head string, slot int, seconds string, counts array<int>"


def _stripes(words: Broadcast, hot: np.ndarray, shard_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs as stripes: language and first word once, with all second words in order and their counts. A hot first word's
    stripe is cut into SLOTS by the second word."""
    for shard, hashes, ids, both in _linked(2, words, None, shard_words, batches):
        yield from _stripes_of(shard, hashes, hot, ids, both)
        del shard, hashes, ids, both


def _stripes_of(shard: Shard, hashes: np.ndarray, hot: np.ndarray, ids: np.ndarray, both: np.ndarray) -> Iterator[pa.RecordBatch]:
    for found, counts in phrase_counts(ids, both, shard.upto, 2, 2):
        if not len(counts):
            continue
        names, lang_of = pa.array(shard.words, pa.binary()).cast(pa.string()), np.array(shard.lang_of, np.int64)
        rank = np.empty(len(names), np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        first, second = found[:, 0].astype(np.int64), found[:, 1]
        stripe = first * SLOTS + np.where(np.isin(hashes, hot)[first], hashes[second] % np.uint64(SLOTS), 0).astype(np.int64)
        order = np.argsort(stripe * len(names) + rank[second])
        stripe, second, counts = stripe[order], second[order], counts[order].astype(np.int32)
        del first, order, rank
        starts = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]])
        bounds = np.r_[starts, len(stripe)].astype(np.int32)
        # Whole stripes up to about BATCH_ROWS pairs.
        cuts = np.flatnonzero(np.r_[True, np.diff(starts // BATCH_ROWS) > 0])
        for s, e in zip(cuts, [*cuts[1:], len(starts)], strict=True):
            own, inside, heads = slice(bounds[s], bounds[e]), pa.array(bounds[s : e + 1] - bounds[s]), stripe[starts[s:e]] // SLOTS
            keys = pc.binary_join_element_wise(pa.array(shard.langs, pa.string()).take(pa.array(lang_of[heads])), names.take(pa.array(heads)), "\t")
            seconds = pc.binary_join(pa.ListArray.from_arrays(inside, names.take(pa.array(second[own]))), " ")
            numbers = pa.ListArray.from_arrays(inside, pa.array(counts[own]))
            yield pa.RecordBatch.from_arrays([keys, pa.array((stripe[starts[s:e]] % SLOTS).astype(np.int32)), seconds, numbers], ["head", "slot", "seconds", "counts"])


def hot_words(words: DataFrame) -> np.ndarray:
    """The hashes of the words that make up more than a HOT_KEYS-th of all frequent words; there are fewer than that."""
    total = words.agg(F.sum("a")).first()[0] or 0
    rows = words.filter(F.col("a") > total / HOT_KEYS).select("lang", "phrase").collect()
    return word_hashes([r["phrase"].encode() for r in rows], [r["lang"] for r in rows])


def frequent_phrases(docs: DataFrame, longest: int, least: int, shard_words: int, most_bits: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, length, a) of all phrases of 1 to `longest` words with `least` occurrences, and (lang, n) of all
    languages.

    Three passes: words; pairs of frequent words; longer phrases of which all pairs are frequent. No frequent phrase has an
    infrequent part, so the filters that say so lose none. Each shard's counts are added up by phrase; pairs, of which
    there are most, are shuffled as stripes (_stripes) and fall apart where they are added up.
    """
    read = docs.select("text", "lang")
    schema = "key string, count long"

    def parts_of(key: str) -> tuple[Column, Column]:
        phrase = F.substring_index(key, "\t", -1)
        return F.substring(key, F.lit(1), F.length(key) - F.length(phrase) - 1), phrase

    def merged(counts: DataFrame, label: str) -> DataFrame:
        whole = counts.groupBy("key").agg(F.sum("count").alias("a"))
        lang, phrase = parts_of("key")
        named = whole.select(lang.alias("lang"), phrase.alias("phrase"), "a").filter((F.col("a") >= least) | (F.col("phrase") == ""))
        return staged(named.withColumn("length", F.size(F.split("phrase", " "))), label)

    words = merged(read.mapInArrow(partial(_words, shard_words), schema), "words")
    totals, words = words.filter("phrase = ''").select("lang", F.col("a").alias("n")), words.filter("phrase <> ''")
    if longest < 2:
        return words, totals
    known = filter_of(words, most_bits)
    stripes = read.mapInArrow(partial(_stripes, known, hot_words(words), shard_words), STRIPE).repartition("head", "slot")
    each = stripes.select("head", "slot", F.split("seconds", " ").alias("second"), "counts").select("head", "slot", F.explode(F.arrays_zip("second", "counts")).alias("x"))
    # Dealt by head and slot already, so this adds no shuffle.
    whole = each.groupBy("head", "slot", F.col("x.second").alias("second")).agg(F.sum("x.counts").alias("a")).filter(F.col("a") >= least)
    lang, first = parts_of("head")
    pairs = staged(whole.select(lang.alias("lang"), F.concat_ws(" ", first, "second").alias("phrase"), "a", F.lit(2).alias("length")), "pairs")
    found = words.unionByName(pairs)
    if longest > 2:
        of_pairs = filter_of(pairs, most_bits)
        found = found.unionByName(merged(read.mapInArrow(partial(_phrases, 3, longest, known, of_pairs, shard_words), schema), "phrases"))
    return found, totals


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP, shard_words: int = SHARD_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """Documents (text, lang, ...) -> lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `longest`
    words (at most LONGEST) by how much oftener they occur than their parts would by chance.

    A-Z become small; texts are cut into pieces at . , ; : ! ? and at \\n to \\r, those into words at spaces and tabs, and
    phrases lie within pieces. a: occurrences, `least` or more; n: all words of the language; for the cut into two parts
    with l and r occurrences that gives the lowest score: floor(1000 a n / (l r)), ties to the shortest first part. A phrase
    goes where a phrase one word longer that contains it has share % of its occurrences: with any longer one of so many,
    one of the lengths between has as many. Order: score, a, both descending, phrase by its bytes.

    A null lang is `und`. Null and empty texts have no words, repeated rows count as often as they are there, no rows
    give none, other columns are ignored. Numbers are exact up to 38 digits.

    Shuffled are counts by phrase, added up in each task before; a filter broadcasts most_bits bits at most; keys that most
    phrases share (frequent parts, a language) are joined by join_hot; the order comes from a sort by ranges.
    """
    if longest > LONGEST:
        raise ValueError(f"phrases have {LONGEST} words at most")
    found, totals = frequent_phrases(docs, longest, least, shard_words, most_bits)
    candidates = found.filter("length > 1").select("lang", "phrase", "length", "a", F.split("phrase", " ").alias("words"))
    part = lambda first, size: F.array_join(F.slice("words", first, size), " ")
    parents = candidates.filter("length > 2").select("lang", F.explode(F.array(part(F.lit(1), F.col("length") - 1), part(F.lit(2), F.col("length") - 1))).alias("phrase"), "a")
    parents = parents.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    own = candidates.join(parents, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    cuts = own.select("lang", "phrase", "length", "a", "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"))
    cuts = staged(cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest")), "cuts")
    left = staged(join_hot(cuts, found.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"]), "left")
    both = staged(join_hot(left, found.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]), "both")
    known = join_hot(both, totals, ["lang"])
    exact = {c: F.col(c).cast("decimal(20,0)") for c in ("a", "n", "l", "r")}
    score = F.expr("(1000 * x.a * x.n) div (x.l * x.r)")
    scored = known.withColumn("x", F.struct(*[v.alias(c) for c, v in exact.items()])).withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = staged(scored.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "scored")
    placed = staged(in_order(scored, F.asc("lang"), F.desc("score"), F.desc("a"), F.asc("phrase")), "placed")
    ranked = join_hot(placed, placed.groupBy("lang").agg(F.min("position").alias("start")), ["lang"])
    rank = (F.col("position") - F.col("start") + 1).alias("rank")
    return ranked.select("lang", rank, "phrase", "a", "l", "r", "n", "score").filter(F.col("rank") <= top)


def oracle() -> str:
    upper, lower = ascii_uppercase, ascii_lowercase
    return f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
runs AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM runs, range(1, {LONGEST + 1}) AS t(m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, phrase, m, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, sum(len(w))::bigint AS n FROM worded GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
longer AS (SELECT DISTINCT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, a AS more
  FROM candidates, range(1, {LONGEST + 1}) AS t(k), range(1, {LONGEST + 1}) AS u(i) WHERE k < m AND i + k - 1 <= m),
own AS (SELECT * FROM candidates c WHERE NOT EXISTS (FROM longer l WHERE l.lang = c.lang AND l.phrase = c.phrase AND 100 * l.more >= {SHARE} * c.a)),
cuts AS (SELECT lang, phrase, m, a, k, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest FROM own, range(1, {LONGEST}) AS t(k) WHERE k < m),
scored AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n, ((1000::hugeint * c.a * n) // (x.a::hugeint * y.a))::bigint AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = first_part JOIN f y ON y.lang = c.lang AND y.phrase = rest JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= {TOP}"""
