"""Token-id files: an adaptive context-mixing range coder over independent, checksummed blocks."""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import staging_folder

#: The id that ends a document; ids in a block; ids after which a segment ends with its document; ids that there can be.
END, BLOCK_IDS, SEGMENT_IDS, IDS = 2, 2048, 1 << 23, 1 << 16
#: How often a pair of ids must stand in a segment to become a symbol, and bits of a slot of the table of pairs.
LEAST, PAIR_BITS = 32, 18
#: Slots of a block's table for order 2, steps of confidence in a guess, and bits of a probability.
SLOTS, SURE, BITS = 1024, 16, 12
#: Order 0: classes are TOPICS groups of blocks times tiers of frequency that end with these ranks; what a class's count
#: grows by, the sum at which a block halves its counts, the sum it starts with; bits of an id's share of its class; and
#: the commonest ids by which blocks are grouped.
TOPICS, TIERS, STEP, LIMIT, START, SHARE_BITS, PROFILE = 4, (64, 1024, 8192), 24, 1 << 11, 128, 16, 256
CLASSES = TOPICS * (len(TIERS) + 1)
#: The coder's interval is 64 bits wide and moves out 16 at once; it holds 40 bits at least before an id is coded, of
#: which the guess takes BITS, the class up to 12 and the id in its class SHARE_BITS.
UNIT, TOP, BOTTOM = np.uint64(16), np.uint64(1 << 48), np.uint64(1 << 40)

_STRETCH = np.array([round(256 * math.log((x + 0.5) / (4095.5 - x))) for x in range(4096)], np.int32)
#: What becomes of a slot of confidence c (rows) if its id was wrong or right (columns), shifted; 0: it takes the new id.
_NEXT = np.array([[(c >> 1) << 16 if c > 1 else 0, min(c + 1, SURE - 1) << 16 if c else 0] for c in range(SURE)], np.int32).ravel()
_SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2048, 2048)], np.int32)


class DamagedBlock(ValueError):
    """A block whose ids don't have the checksum that was stored with it."""


class Joins:
    """A segment's commonest pairs of ids, each written as one symbol: an id that the segment doesn't have. So there are
    far fewer symbols to code one after the other than ids, in fewer bits."""

    def __init__(self, symbols: np.ndarray, pairs: np.ndarray):
        self.symbols, self.pairs = symbols, pairs  # symbols and (first << 16 | second), both ascending
        self.first, self.second = np.arange(IDS, dtype=np.int32), np.full(IDS, -1, np.int32)
        self.first[symbols], self.second[symbols] = pairs >> 16, pairs & 0xFFFF

    @classmethod
    def of(cls, ids: np.ndarray) -> Joins:
        free = np.flatnonzero(np.bincount(ids, minlength=IDS) == 0)
        pairs = np.sort(cls.neighbours(ids))
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(pairs) else np.empty(0, np.int64)
        n, pairs = np.diff(np.r_[starts, len(pairs)]), pairs[starts]
        often = np.flatnonzero(n >= LEAST)
        often = often[np.argsort(-n[often], kind="stable")[: len(free)]]
        # Of pairs that share a slot of the look-up table the commonest counts.
        _, at = np.unique(cls.slot(pairs[often]), return_index=True)
        pairs = np.sort(pairs[often[at]])
        return cls(free[: len(pairs)], pairs)

    @staticmethod
    def neighbours(ids: np.ndarray) -> np.ndarray:
        ids = ids.astype(np.uint32)
        return ids[:-1] << np.uint32(16) | ids[1:]

    @staticmethod
    def slot(pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(32 - PAIR_BITS)).astype(np.int64)

    def join(self, ids: np.ndarray, block_ids: int) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, their number in each block of block_ids ids): from left to right, every pair that is one, within
        its block."""
        if not len(self.pairs):
            return ids.astype(np.int32), np.diff(np.r_[0 : len(ids) : block_ids, len(ids)])
        table = np.zeros(1 << PAIR_BITS, np.uint32)
        symbol = np.full(1 << PAIR_BITS, -1, np.int32)
        at = self.slot(self.pairs)
        table[at], symbol[at] = self.pairs, self.symbols
        at_once = block_ids * max(1, (1 << 16) // block_ids)  # so that a processor's cache holds what is in between
        parts = [self._join(ids[s : s + at_once], block_ids, table, symbol) for s in range(0, len(ids), at_once)]
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])

    @classmethod
    def _join(cls, ids: np.ndarray, block_ids: int, table: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = cls.neighbours(ids)
        at = cls.slot(pairs)
        hit = table.take(at) == pairs
        hit[pairs == 0] &= symbol[0] >= 0  # empty slots hold this pair
        hit[block_ids - 1 :: block_ids] = False
        # Of pairs that overlap, every other one counts from the first of their row.
        row = np.arange(len(hit), dtype=np.int32)
        row -= np.maximum.accumulate(np.where(hit, np.int32(-1), row))
        hit &= (row & 1).astype(bool)
        symbols, keep = ids.astype(np.int32), np.ones(len(ids), bool)
        here = np.flatnonzero(hit)
        symbols[here] = symbol.take(at[here])
        keep[here + 1] = False
        return symbols[keep], np.add.reduceat(keep, np.arange(0, len(ids), block_ids), dtype=np.int64)

    def part(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The inverse of join: ids, and how many each block has."""
        both = np.stack([self.first, self.second], axis=1).view(np.int64).ravel()
        parts = (both.take(symbols[s : s + (1 << 15)]).view(np.int32) for s in range(0, len(symbols), 1 << 15))
        ids = np.concatenate([x.take(np.flatnonzero(x >= 0)) for x in parts])
        n = 1 + (self.second >= 0).astype(np.int8)
        return ids, np.add.reduceat(n.take(symbols), np.cumsum(lengths) - lengths, dtype=np.int64)


class Prior:
    """The state to which every block of a segment is reset, stored with the segment: the pairs that are symbols, each
    symbol's class and share of it (order 0), and the commonest successor of each with its share in sixteenths (order 1)."""

    def __init__(self, joins: Joins, kind: np.ndarray, share: np.ndarray, weights: np.ndarray, after: np.ndarray, sure: np.ndarray):
        self.joins = joins
        self.kind, self.share, self.weights, self.after, self.sure = kind, share, weights, after, sure
        present = np.flatnonzero(share)
        order = present[np.argsort(kind[present], kind="stable")]
        ends = np.cumsum(share[order])
        self.first = np.zeros(IDS, np.int64)
        self.first[order] = (ends - share[order]) & ((1 << SHARE_BITS) - 1)  # every class that occurs fills its range
        self.by_share = np.zeros(CLASSES << SHARE_BITS, np.uint16)
        for c in np.unique(kind[present]).tolist():
            own = order[kind[order] == c]
            self.by_share[c << SHARE_BITS : (c + 1) << SHARE_BITS] = np.repeat(own, share[own])
        self.guess = sure.astype(np.int32) << 16 | after
        chance = share / (1 << SHARE_BITS) * (weights / weights.sum())[kind]
        self.odds = _STRETCH[np.clip(chance * 4096, 0, 4095).astype(int)]

    @classmethod
    def of(cls, ids: np.ndarray, block_ids: int = BLOCK_IDS) -> Prior:
        joins = Joins.of(ids)
        return cls.of_symbols(joins.join(ids, block_ids)[0], joins, block_ids)

    @classmethod
    def of_symbols(cls, ids: np.ndarray, joins: Joins, block_ids: int = BLOCK_IDS) -> Prior:
        counts = np.bincount(ids, minlength=IDS)
        rank = np.empty(IDS, np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(IDS)
        topic = cls.topics(ids, rank, block_ids)
        cut = len(ids) // block_ids * block_ids
        in_topic = np.stack([np.bincount(ids[:cut].reshape(-1, block_ids)[topic[: cut // block_ids] == k].ravel(), minlength=IDS) for k in range(TOPICS)])
        in_topic[topic[-1]] += np.bincount(ids[cut:], minlength=IDS)
        own = (in_topic / np.maximum(in_topic.sum(axis=1, keepdims=True), 1)).argmax(axis=0)
        kind = (own * (len(TIERS) + 1) + np.searchsorted(TIERS, rank, side="right")).astype(np.uint8)
        totals = np.bincount(kind, counts, minlength=CLASSES)
        members = np.bincount(kind, counts > 0, minlength=CLASSES)
        free = ((1 << SHARE_BITS) - members)[kind]
        share = np.where(counts > 0, 1 + (free * (counts / np.maximum(totals, 1)[kind])).astype(np.int64), 0)
        for c in np.flatnonzero(members):  # what rounding left goes to the class's commonest id
            inside = np.flatnonzero((kind == c) & (counts > 0))
            share[inside[np.argmax(counts[inside])]] += (1 << SHARE_BITS) - share[inside].sum()
        weights = np.maximum(1, np.round(START * totals / len(ids))).astype(np.int32)
        pairs = np.sort(Joins.neighbours(ids))
        after, sure = np.zeros(IDS, np.int32), np.zeros(IDS, np.uint8)
        if len(pairs):
            starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
            n, pair = np.diff(np.r_[starts, len(pairs)]), pairs[starts].astype(np.int64)
            groups = np.flatnonzero(np.r_[True, pair[1:] >> 16 != pair[:-1] >> 16])
            best, before = np.maximum.reduceat(n << 16 | (pair & 0xFFFF), groups), pair[groups] >> 16
            often = best >> 16 >= 4
            before, best = before[often], best[often]
            after[before] = best & 0xFFFF
            sure[before] = np.clip((best >> 16) * 16 // counts[before], 1, SURE - 1)
        return cls(joins, kind, share, weights, after, sure)

    @staticmethod
    def topics(ids: np.ndarray, rank: np.ndarray, block_ids: int) -> np.ndarray:
        """A group for each block_ids symbols, by a few rounds of k-means on the shares of the commonest ids. Products are
        einsum's: the threads that a BLAS keeps waiting would cost more."""
        seen = np.minimum(rank, PROFILE - 1).astype(np.uint8)[ids]
        profile = np.stack([np.bincount(seen[at : at + block_ids], minlength=PROFILE) for at in range(0, len(ids), block_ids)])
        profile = np.sqrt(profile / np.maximum(profile.sum(axis=1, keepdims=True), 1))
        chosen = [0]
        for _ in range(TOPICS - 1):  # farthest first
            chosen.append(int(np.einsum("bi,ki->bk", profile, profile[chosen]).max(axis=1).argmin()))
        centres = profile[chosen]
        for _ in range(6):
            topic = (np.einsum("bi,ki->bk", profile, centres) - (centres * centres).sum(axis=1) / 2).argmax(axis=1)
            centres = np.stack([profile[topic == k].mean(axis=0) if (topic == k).any() else centres[k] for k in range(TOPICS)])
        return topic

    def pack(self) -> bytes:
        present = np.flatnonzero(self.share)
        parts = [self.weights.astype("<u2"), np.array([len(present)], "<u4"), np.diff(present, prepend=0).astype("<u2"), self.kind[present], (self.share[present] - 1).astype("<u2"), self.sure[present], np.where(self.sure, self.after, 0)[present].astype("<u2")]
        first, second = self.joins.pairs >> 16, self.joins.pairs & 0xFFFF
        parts += [np.array([len(first)], "<u4"), *(x.astype("<u2") for x in (np.diff(self.joins.symbols, prepend=0), np.diff(first, prepend=0), second))]
        return zlib.compress(b"".join(x.tobytes() for x in parts), 6)

    @classmethod
    def unpack(cls, data: bytes) -> Prior:
        data, at = zlib.decompress(data), 0

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, dtype, n, at)
            at += x.nbytes
            return x

        weights = take("<u2", CLASSES).astype(np.int32)
        n = int(take("<u4", 1)[0])
        present = np.cumsum(take("<u2", n).astype(np.int64))
        columns = [np.zeros(IDS, t) for t in (np.uint8, np.int64, np.uint8, np.int32)]
        for column, dtype in zip(columns, ("u1", "<u2", "u1", "<u2"), strict=True):
            column[present] = take(dtype, n)
        kind, share, sure, after = columns
        share[present] += 1
        n = int(take("<u4", 1)[0])
        symbols, first, second = (take("<u2", n).astype(np.int64) for _ in range(3))
        joins = Joins(np.cumsum(symbols), np.cumsum(first) << 16 | second)
        return cls(joins, kind, share, weights, after, sure)


class Model:
    """The state of many blocks at once, one lane each; every operation is integer arithmetic on whole lanes, so that
    encoder and decoder agree on any machine."""

    def __init__(self, lanes: int, prior: Prior):
        self.prior = prior
        self.table = np.zeros(lanes * SLOTS, np.int32)  # order 2: confidence << 16 | predicted id
        # Chance of 2^16 that a guess is right: order 1, then order 2, each by confidence.
        first = np.r_[(np.arange(SURE) * 2 + 1) << 11, np.full(SURE, 1 << 14)].astype(np.int32)
        self.hit = np.tile(first, lanes)
        self.weight = np.repeat(np.array([[16_000], [30_000], [30_000]], np.int32), lanes, axis=1)
        # Order 0: the classes' counts below each class and, last, all together.
        self.below = np.repeat(np.r_[0, np.cumsum(prior.weights)].astype(np.int16)[:, None], lanes, axis=1)
        self.last = np.zeros((2, lanes), np.uint32)
        self.slot0, self.hit0 = np.arange(lanes) * SLOTS, np.arange(lanes) * (2 * SURE)
        self.names, self.classes = np.arange(lanes), np.arange(CLASSES, dtype=np.int8)[:, None]

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(guessed id, chance that it is right of 2^BITS) for the first n lanes: the longest context that knows an id
        guesses; its chances by order 2, order 1 and order 0 are mixed in the logistic domain with learned weights."""
        c1, c2 = self.last[0, :n], self.last[1, :n]
        self.at2 = self.slot0[:n] + ((c1 * np.uint32(0x85EBCA6B) + c2 * np.uint32(0xC2B2AE35) >> np.uint32(17)) & np.uint32(SLOTS - 1))
        e2, e1 = self.table.take(self.at2), self.prior.guess.take(c1)
        self.n2, self.i2, i1 = e2 >> 16, e2 & 0xFFFF, e1 & 0xFFFF
        guess = np.where(self.n2, self.i2, i1)
        self.h1, self.h2 = self.hit0[:n] + (e1 >> 16) * (i1 == guess), self.hit0[:n] + (self.n2 + SURE)
        self.q1, self.q2 = self.hit.take(self.h1), self.hit.take(self.h2)
        self.s0, self.s1, self.s2 = self.prior.odds.take(guess), _STRETCH.take(self.q1 >> 4), _STRETCH.take(self.q2 >> 4)
        w = self.weight
        dot = w[0, :n] * self.s0
        dot += w[1, :n] * self.s1
        dot += w[2, :n] * self.s2
        dot >>= 16
        dot += 2048
        self.p = _SQUASH.take(dot, mode="clip")
        return guess, self.p

    def learn(self, t: int, n: int, right: np.ndarray, ids: np.ndarray) -> None:
        whole = right.astype(np.int32)
        # Weights and chances learn in turn, each from every other id.
        if t % 2 == 0:
            miss = (whole << BITS) - self.p
            for k, s in enumerate((self.s0, self.s1, self.s2)):
                self.weight[k, :n] += s * miss >> 10
            if t % 32 == 0:  # so often that three products of weight and chance stay within 32 bits
                np.clip(self.weight, 0, 1 << 17, out=self.weight)
        else:
            target = whole * 65535
            self.hit[self.h1] = self.q1 + (target - self.q1 >> 4)
            self.hit[self.h2] = self.q2 + (target - self.q2 >> 4)
        then = _NEXT.take((self.n2 << 1) + (self.i2 == ids))
        self.table[self.at2] = np.where(then, then | self.i2, ids | 1 << 16)
        self.last[1, :n] = self.last[0, :n]
        self.last[0, :n] = ids

    def share_of(self, kind: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts below the class of each of the first n lanes, and of the class."""
        at = kind * self.below.shape[1] + self.names[:n]
        low, high = self.below.ravel().take(at), self.below.ravel().take(at + self.below.shape[1])
        return low.astype(np.uint64), (high - low).astype(np.uint64)

    def count(self, n: int, kind: np.ndarray, right: np.ndarray) -> None:
        """Order 0 learns the class of ids that weren't guessed; a lane whose counts grow large halves them."""
        step = ~right * np.int8(STEP)
        self.below[1:, :n] += (self.classes >= kind.astype(np.int8)).view(np.int8) * step
        big = np.flatnonzero(self.below[-1] > LIMIT)
        if len(big):
            self.below[1:, big] = np.cumsum((np.diff(self.below[:, big], axis=0) + 1) >> 1, axis=0)


class Interval:
    """The range coder's state of many lanes; `move` says what happens to the 16 bits that leave a lane's interval."""

    def __init__(self, lanes: int):
        self.low, self.span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)

    def move(self, lanes: np.ndarray, top: np.ndarray) -> None:
        raise NotImplementedError

    def settle(self, n: int, low: np.ndarray, span: np.ndarray) -> None:
        """Store the first n lanes' interval, after moving out all leading units that can't change any more; an
        interval that has become small across a unit's border is cut there."""
        go = np.flatnonzero(((low ^ (low + span)) < TOP) | (span < BOTTOM))
        while len(go):
            l, s = low.take(go), span.take(go)
            s = np.where((l ^ (l + s)) >= TOP, np.negative(l) & (BOTTOM - np.uint64(1)), s)
            self.move(go, l >> np.uint64(48))
            l, s = l << UNIT, s << UNIT
            low[go], span[go] = l, s
            go = go[((l ^ (l + s)) < TOP) | (s < BOTTOM)]
        self.low[:n], self.span[:n] = low, span


class Writer(Interval):
    def __init__(self, lanes: int, capacity: int):
        super().__init__(lanes)
        self.out, self.start = np.zeros(lanes * capacity, "<u2"), np.arange(lanes) * capacity
        self.at = self.start.copy()

    def move(self, lanes: np.ndarray, top: np.ndarray) -> None:
        at = self.at.take(lanes)
        self.out[at] = top
        self.at[lanes] = at + 1

    def finish(self) -> list[bytes]:
        for shift in (48, 32, 16, 0):
            self.move(np.arange(len(self.at)), self.low >> np.uint64(shift) & np.uint64(0xFFFF))
        return [self.out[s:e].tobytes() for s, e in zip(self.start.tolist(), self.at.tolist(), strict=True)]


class Reader(Interval):
    def __init__(self, payloads: list[bytes]):
        super().__init__(len(payloads))
        width = max(map(len, payloads)) // 2 + 8
        self.at = np.arange(len(payloads)) * width
        self.data = np.frombuffer(b"".join([p[: len(p) // 2 * 2].ljust(2 * width, b"\0") for p in payloads]), "<u2")
        self.code = np.zeros(len(payloads), np.uint64)
        for _ in range(4):
            self.move(np.arange(len(payloads)), self.code)

    def move(self, lanes: np.ndarray, top: np.ndarray) -> None:
        at = self.at.take(lanes)
        # Only a damaged block reads beyond its own units.
        self.code[lanes] = self.code.take(lanes) << UNIT | self.data.take(at, mode="clip")
        self.at[lanes] = at + 1


def encode_blocks(ids: np.ndarray, prior: Prior, block_ids: int = BLOCK_IDS) -> list[bytes]:
    """Ids below IDS, all of which the prior knows -> a payload for each block of block_ids ids (the last may be
    shorter), all lanes in step."""
    return encode_symbols(*prior.joins.join(ids, block_ids), prior)


class Lanes:
    """Where symbols of blocks lie in a grid of a row for each step and a lane for each block, long blocks first."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.rank = np.empty(len(lengths), np.int64)
        self.rank[self.order] = np.arange(len(lengths))
        self.steps = int(lengths.max())
        #: Lanes that a step still has.
        self.open = np.searchsorted(-lengths[self.order], -np.arange(self.steps)).tolist()
        before = np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.place = (np.arange(len(before)) - before) * len(lengths) + np.repeat(self.rank, lengths)


def encode_symbols(symbols: np.ndarray, lengths: np.ndarray, prior: Prior) -> list[bytes]:
    """Payloads of blocks of so many symbols each: their number, then what the coder makes of them."""
    if not len(lengths):
        return []
    if lengths.max() >= 1 << 16:
        raise ValueError("blocks must have fewer symbols")
    at, lanes = Lanes(lengths), len(lengths)
    grid = np.zeros((at.steps, lanes), np.int32)
    grid.ravel()[at.place] = symbols
    model, out = Model(lanes, prior), Writer(lanes, 2 * at.steps + 16)
    share, first, kinds = prior.share.astype(np.uint64), prior.first.astype(np.uint64), prior.kind.astype(np.int64)
    for t, n in enumerate(at.open):
        actual = grid[t, :n]
        guess, p = model.predict(n)
        right = guess == actual
        low, span = out.low[:n], out.span[:n]
        bound = (span >> np.uint64(BITS)) * p.astype(np.uint64)
        kind = kinds.take(actual)
        below, own = model.share_of(kind, n)
        s = (span - bound) // model.below[-1, :n].astype(np.uint64)
        inner = s * own >> np.uint64(SHARE_BITS)
        low = np.where(right, low, low + bound + below * s + first.take(actual) * inner)
        span = np.where(right, bound, inner * share.take(actual))
        model.count(n, kind, right)
        out.settle(n, low, span)
        model.learn(t, n, right, actual)
    made = out.finish()
    return [int(n).to_bytes(2, "little") + made[k] for n, k in zip(lengths, at.rank.tolist(), strict=True)]


def decode_blocks(payloads: list[bytes], n_ids: int, prior: Prior, block_ids: int = BLOCK_IDS) -> np.ndarray:
    """The inverse of encode_blocks."""
    lanes = len(payloads)
    if not lanes:
        return np.empty(0, np.int32)
    want = np.full(lanes, block_ids)
    want[-1] = n_ids - (lanes - 1) * block_ids
    # A damaged number could be anything; a block has a symbol and no more symbols than ids.
    lengths = np.clip([int.from_bytes(p[:2], "little") for p in payloads], 1, want)
    at = Lanes(lengths)
    grid = np.zeros((at.steps, lanes), np.int32)
    model, source = Model(lanes, prior), Reader([payloads[k][2:] for k in at.order])
    share, first = prior.share.astype(np.uint64), prior.first.astype(np.uint64)
    for t, n in enumerate(at.open):
        guess, p = model.predict(n)
        low, span = source.low[:n], source.span[:n]
        bound = (span >> np.uint64(BITS)) * p.astype(np.uint64)
        left = source.code[:n] - low
        right = left < bound
        left -= bound  # of lanes that were guessed, what follows is thrown away
        total = model.below[-1, :n]
        s = (span - bound) // total.astype(np.uint64)
        value = np.minimum(left // s, total.astype(np.uint64) - np.uint64(1)).astype(np.int16)
        kind = (model.below[1:, :n] <= value).sum(axis=0, dtype=np.int8).astype(np.int64)
        below, own = model.share_of(kind, n)
        inner = s * own >> np.uint64(SHARE_BITS)
        before = below * s
        inside = np.minimum((left - before) // np.maximum(inner, np.uint64(1)), np.uint64((1 << SHARE_BITS) - 1)).astype(np.int64)
        missed = prior.by_share.take((kind << SHARE_BITS) + inside).astype(np.int32)
        ids = np.where(right, guess, missed)
        low = np.where(right, low, low + bound + before + first.take(missed) * inner)
        span = np.where(right, bound, inner * share.take(missed))
        model.count(n, kind, right)
        source.settle(n, low, span)
        grid[t, :n] = ids
        model.learn(t, n, right, ids)
    ids, got = prior.joins.part(grid.ravel()[at.place], lengths)
    if (got != want).any():
        raise DamagedBlock(f"block {np.flatnonzero(got != want)[0]} of {lanes}")
    return ids


SEGMENT = "segment long, n_ids long, prior binary, blocks array<struct<n_ids:int,crc32:long,payload:binary>>, documents array<struct<doc_id:long,n_tokens:long>>"
_SEGMENT = pa.schema(
    [
        ("segment", pa.int64()),
        ("n_ids", pa.int64()),
        ("prior", pa.binary()),
        ("blocks", pa.list_(pa.struct([("n_ids", pa.int32()), ("crc32", pa.int64()), ("payload", pa.binary())]))),
        ("documents", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64())]))),
    ]
)


def _segments(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents -> segments: whole documents up to SEGMENT_IDS ids, numbered upward within the partition."""
    from pyspark import TaskContext

    encoder = tokens.encoder(path, "word")
    end = np.array([END], encoder.dtype)
    made, streams, documents, held = 0, [], [], 0
    task = TaskContext.get()
    assert task is not None

    def segment() -> pa.RecordBatch:
        ids = np.concatenate(streams)
        return pa.RecordBatch.from_pylist([{"segment": (task.partitionId() << 32) + made, **write_segment(ids), "documents": documents}], schema=_SEGMENT)

    for batch in batches:
        for part in tokens.portions(batch, chars=tokens.ENCODE_CHARS):
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(tokens.texts_of(part)), strict=True):
                streams += ids, end
                documents.append({"doc_id": doc_id, "n_tokens": len(ids) + 1})
                held += len(ids) + 1
                if held >= SEGMENT_IDS:
                    yield segment()
                    made, streams, documents, held = made + 1, [], [], 0
    if documents:
        yield segment()
    del streams, documents
    tokens.give_back()


def write_segment(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> dict:
    """n_ids, prior and blocks of a segment; ids must be below IDS."""
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < IDS:
        raise ValueError(f"ids must be below {IDS}")
    joins = Joins.of(ids)
    symbols, lengths = joins.join(ids, block_ids)
    prior = Prior.of_symbols(symbols, joins, block_ids)
    payloads = encode_symbols(symbols, lengths, prior)
    cut = [ids[s : s + block_ids].astype("<u4") for s in range(0, len(ids), block_ids)]
    return {"n_ids": len(ids), "prior": prior.pack(), "blocks": [{"n_ids": len(x), "crc32": zlib.crc32(x), "payload": p} for x, p in zip(cut, payloads, strict=True)]}


def read_segment(n_ids: int, prior: bytes, blocks: list[dict]) -> np.ndarray:
    size = blocks[0]["n_ids"] if blocks else 1
    ids = decode_blocks([b["payload"] for b in blocks], n_ids, Prior.unpack(prior), size)
    for k, b in enumerate(blocks):
        if zlib.crc32(ids[k * size : k * size + b["n_ids"]].astype("<u4")) != b["crc32"]:
            raise DamagedBlock(f"block {k} of {len(blocks)}")
    return ids


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            ids = read_segment(row["n_ids"], row["prior"], row["blocks"]).astype("<u4")
            lengths = [d["n_tokens"] for d in row["documents"]]
            ends = np.cumsum(lengths, dtype=np.int64)
            crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends, lengths, strict=True)]
            columns = [pa.array([row["segment"]] * len(crc), pa.int64()), pa.array([d["doc_id"] for d in row["documents"]], pa.int64()), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "doc_id", "inside", "n_tokens", "ids_crc32"])


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str) -> None:
    """Write the ids of all documents (doc_id, text, ...) in ascending doc_id order.

    The format: Parquet files with a row for each segment, segments ascending. A segment holds whole documents: their
    doc_ids and lengths, the Prior, and blocks of BLOCK_IDS ids (the last may have fewer), each coded from a model that
    is reset to the prior and stored with the crc32 of its ids.
    Texts are range-partitioned by doc_id and sorted, so partitions follow one another; nothing global passes through
    one task. Null doc_ids come first; equal ones in order of their text's hash; null texts are empty.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    encode = lambda batches: _segments(tokenizer_path, batches)
    ordered.select("doc_id", "text").mapInArrow(encode, SEGMENT).write.parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Decode the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32. Damaged blocks raise.

    Each segment is decoded where it is read. Starts come from the segments' sizes, one small row for each segment.
    """
    files = spark.read.schema(SEGMENT).parquet(folder)
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("segment", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    found = files.mapInArrow(_digests, "segment long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(starts, "segment").select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """write_ids to a new folder of the shared one, then read_ids. No rows give no rows; other columns are ignored."""
    folder = f"{staging_folder(docs.sparkSession)}/{uuid.uuid4().hex}-ids"
    write_ids(docs, tokenizer_path, folder)
    return read_ids(docs.sparkSession, folder)
