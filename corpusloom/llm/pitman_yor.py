"""Hierarchical Pitman-Yor language model (Chinese restaurant franchise).

Every context word is a restaurant whose customers are the training tokens that
follow it and whose dishes are the words; all of them share one parent, the
restaurant of the empty context, whose customers are their tables and whose base
is uniform over the known words and one unknown. Seating is sampled by Gibbs: a
sweep seats all customers anew. The number of tables of a dish of up to
``DIRECT`` customers is drawn from its distribution given all other dishes (by
generalised Stirling numbers, which sum over all seatings). Those of a larger
dish first sit down one after the other by the restaurant's predictive rule,
thinned; then blocks of them, drawn at random, get up and sit down again until
as many have moved as there are, each block's new seating taken by
Metropolis-Hastings. The predictive probability of a word is averaged over several seatings, in all
restaurants of the franchise alike:

    P(w | u) = mean over seatings of
               (c_uw - d t_uw) / (s + c_u) + (s + d t_u) / (s + c_u) * P0(w)

How it is spread. Words are 64-bit hashes. Restaurants are dealt to buckets of
about ``BUCKET_TOKENS`` tokens by the hash of the context; contexts that hold
1 / 512 of all tokens or more (at most 683, by counting) are split by dish, with
their table totals as of the last round. One round is

    texts -> packed (context, word, count) blocks per bucket    (map, shuffle)
    bucket: seat the customers under the parent of the round before,
            send each word's tables to the word's own part      (shuffle)
    word part: seat the root, answer every bucket that asked    (stored table)

The first round seats every dish at one table and gives the root its first
customers. After the last round the texts are read once more, with documents;
a bucket turns its pairs into probabilities and sends sums back to the buffer
of documents they came from. A pair that is frequent inside a buffer keeps its
document list there and asks for its value only, so a pair that fills a third
of the corpus is still a few bytes a buffer. Nothing but totals (two counts of
a level, tokens, words) and the split contexts reaches the driver; all counts
are over all training rows.

Dishes of one number of customers move in the same step of a sweep and see the
totals of the step before, as in other parallel samplers of this model.

Defined cases: a null text is empty and has its end token only; a null
``doc_id`` is a training row; repeated rows count as often as they occur; an
empty table gives no rows; with no training rows every probability is 1 over
the one unknown word; texts of any length are scored whole; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import discard, prepare, release, stored
from corpusloom.llm.quality_model import fold
from corpusloom.session import scratch_dir

BUCKET_TOKENS = 1 << 21    # tokens of the restaurants in a bucket, about
BUFFER_BYTES = 12 << 20    # bytes of text that a task packs at a time
BUFFER_DOCS = 1 << 15      # documents of a buffer, at most (their numbers are 16 bits with a flag)
FREQUENT = 64              # tokens of a pair in a buffer from which its documents stay in the buffer
ROUNDS = 1                 # sampling rounds after the first
SAMPLES = 2                # seatings of the last round that are averaged
DIRECT = 1024              # customers of a dish up to which its tables are drawn by Stirling numbers
CELLS = 1 << 18            # numbers of tables that are weighed side by side
ONE_BY_ONE = 64            # customers of a dish that sit down in a step each; then a step goes to the next new table
FEW = 24                   # dishes that are seated one by one, as arrays cost more there
STRENGTH = 1.0
BLOCK = 1 << 20            # bytes that are hashed at a time
HELD_OUT = 1               # remainder of crc32(doc_id) modulo five

BEGIN, END = np.uint64(1), np.uint64(2)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

MESSAGE = "kind int, at long, src long, body binary, sums array<double>"
PAIRS, ASK, TELL, TOTALS, SEATS, DOCS, SCORES, SPLIT = range(8)


# ---------------------------------------------------------------- words

def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def pair_key(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(u * _BASE + w)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (_BASE, _INVERSE):
            x = np.full(max(n, BLOCK + 1), base)
            x[0] = 1
            _POWERS.append(np.cumprod(x, dtype=np.uint64))
    return _POWERS


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, in order, and the text of each."""
    raw = [t.encode("utf-8") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    gap = _SPACE[data]
    edge = np.nonzero(gap[1:] != gap[:-1])[0] + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    start, stop = edge[::2], edge[1::2]
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):  # blocks of whole words; a longer word is a block of its own
        j = max(i + 1, int(np.searchsorted(stop, start[i] + BLOCK, side="right")))
        lo, hi = start[i], stop[j - 1]
        up, down = _powers(int(hi - lo) + 1)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=total[1:])
        out[i:j] = (total[stop[i:j] - lo] - total[start[i:j] - lo]) * down[start[i:j] - lo]
        i = j
    return mix(out) | np.uint64(4), np.searchsorted(ends, start, side="right")


def sequences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Context, word and text of every token, and the tokens of each text."""
    h, text = word_hashes(texts)
    n = np.bincount(text, minlength=len(texts)) + 1
    w = np.full(len(h) + len(texts), END)
    w[np.arange(len(h)) + text] = h
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[np.cumsum(n) - n] = BEGIN
    return u, w, np.repeat(np.arange(len(texts)), n), n


# ---------------------------------------------------------------- packed blocks

def small(x: np.ndarray) -> np.ndarray:
    """Non-negative numbers, mostly below 255: a byte each, the others behind."""
    low = np.minimum(x, 255).astype(np.uint8)
    return np.concatenate([low, x[low == 255].astype(np.uint64).view(np.uint8)])


def unsmall(raw: np.ndarray, n: int) -> np.ndarray:
    out = raw[:n].astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:].tobytes(), dtype=np.uint64).astype(np.int64)
    return out


def frame(*parts: np.ndarray) -> bytes:
    parts = [np.ascontiguousarray(p).tobytes() for p in parts]
    return np.array([len(parts), *map(len, parts)], dtype=np.uint64).tobytes() + b"".join(parts)


def unframe(body: bytes, *types: type) -> list[np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    sizes = np.frombuffer(body, dtype=np.uint64, count=n, offset=8).astype(np.int64)
    at, out = 8 + 8 * n, []
    for size, t in zip(sizes, types):
        out.append(np.frombuffer(body, dtype=t, count=size // np.dtype(t).itemsize, offset=at))
        at += size
    return out


def _buffers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray, list[str]]]:
    """(number, doc ids, held out, texts) of bounded runs of a partition's rows."""
    number = TaskContext.get().partitionId() << 32
    ids, held, texts, size = [], [], [], 0

    def done():
        return number, pa.concat_arrays(ids), np.concatenate(held), texts
    for b in batches:
        ids.append(b.column(0))
        held.append(b.column(1).to_numpy(zero_copy_only=False).astype(bool))
        more = b.column(2).to_pylist()
        texts = texts + more
        size += b.column(2).nbytes
        if size >= BUFFER_BYTES or len(texts) + len(more) > BUFFER_DOCS:
            yield done()
            number, ids, held, texts, size = number + 1, [], [], [], 0
    if texts:
        yield done()


def _bucket(u: np.ndarray, w: np.ndarray, split: np.ndarray, buckets: int) -> np.ndarray:
    h = mix(u)
    if len(split):
        hot = split[np.minimum(np.searchsorted(split, u), len(split) - 1)] == u
        h[hot] = pair_key(u[hot], w[hot])
    return (h % np.uint64(buckets)).astype(np.int64)


def pack_pairs(texts: list[str], held: np.ndarray, split: np.ndarray, buckets: int, with_docs: bool
               ) -> tuple[list[tuple[int, bytes]], bytes | None]:
    """Per bucket one block of the distinct (context, word) pairs with their
    training tokens, and with the documents of their tokens if asked for; then
    the documents of frequent pairs."""
    u, w, doc, n = sequences(texts)
    words, at = np.unique(w, return_inverse=True)
    words = np.concatenate([words, [BEGIN]])
    first = np.cumsum(n) - n
    before = np.empty_like(at)
    before[1:] = at[:-1]
    before[first] = len(words) - 1
    tag = held[doc].astype(np.uint64)
    span = np.uint64(2)
    if with_docs:
        tag, span = tag + np.uint64(2) * doc.astype(np.uint64), np.uint64(2 * len(texts))
    key = np.sort((before.astype(np.uint64) * np.uint64(len(words)) + at.astype(np.uint64)) * span + tag)
    pair, tag = key // span, (key % span).astype(np.int64)
    begin = np.nonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))[0]
    tokens = np.diff(np.append(begin, len(pair)))
    train = np.add.reduceat(1 - (tag & 1), begin)
    pair = pair[begin]
    u, w = words[(pair // np.uint64(len(words))).astype(np.int64)], words[(pair % np.uint64(len(words))).astype(np.int64)]
    bucket = _bucket(u, w, split, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
    own, lists = None, tokens
    if with_docs:
        often = tokens >= FREQUENT
        lists = np.where(often, 0, tokens)
        stays = np.repeat(often, tokens)
        own = frame(n, pair_key(u[often], w[often]), tokens[often].astype(np.uint32), (tag[stays] >> 1).astype(np.uint16))
    out, bucket = [], bucket[order]
    cuts = np.nonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))[0]
    for lo, hi in zip(cuts, cuts[1:]):
        mine = order[lo:hi]
        head = np.nonzero(np.concatenate([[True], u[mine][1:] != u[mine][:-1]]))[0]
        parts = [u[mine][head], small(np.diff(np.append(head, len(mine)))), w[mine], small(train[mine])]
        if with_docs:
            at = np.repeat(begin[mine] - np.concatenate([[0], np.cumsum(lists[mine])[:-1]]), lists[mine]) + np.arange(lists[mine].sum())
            parts += [small(lists[mine]), (tag[at] >> 1).astype(np.uint16)]
        out.append((int(bucket[lo]), frame(*parts)))
    return out, own


def unpack_pairs(body: bytes) -> tuple[np.ndarray, ...]:
    """Contexts, words and training tokens of a block's pairs, then its documents' part."""
    u, run, w, train, *docs = unframe(body, np.uint64, np.uint8, np.uint64, np.uint8, np.uint8, np.uint16)
    return np.repeat(u, unsmall(run, len(u))), w, unsmall(train, len(w)), *docs


# ---------------------------------------------------------------- restaurants

class Restaurants:
    """Distinct pairs of a bucket: dishes in key order with their customers."""

    def __init__(self, blocks: list[bytes]) -> None:
        parts = [unpack_pairs(b)[:3] for b in blocks]
        u, w, c = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, t) for i, t in enumerate((np.uint64, np.uint64, np.int64)))
        key, first, self.of_block = np.unique(pair_key(u, w), return_index=True, return_inverse=True)
        self.key = key
        self.customers = np.bincount(self.of_block, weights=c, minlength=len(key)).astype(np.int64)
        self.contexts, self.context = np.unique(u[first], return_inverse=True)
        self.words, self.word = np.unique(w[first], return_inverse=True)
        self.sizes = [len(p[0]) for p in parts]

    def per_context(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, weights=x, minlength=len(self.contexts))

    def per_word(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=x, minlength=len(self.words)).astype(np.int64)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive numbers."""
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    y = x + 8.0
    r = 1.0 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + series - shift


def _wait(now: int, last: int, start: float, fresh: float, chance: float) -> int:
    """``Seating._next_new`` of one dish."""
    offset = math.lgamma(start + fresh) - math.lgamma(start) - chance

    def joined(upto: int) -> bool:
        x = start + (upto - now)
        return math.lgamma(x) - math.lgamma(x + fresh) + offset >= 0
    if joined(last):
        return last + 1
    low, high, step = now, last, 1
    while now + step < last:
        if not joined(now + step):
            high = now + step
            break
        low, step = now + step, 2 * step
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if joined(middle) else (low, middle)
    return max(high, now + 1)


class Seating:
    """Tables of dishes of a similar number of customers, sampled side by side."""

    def __init__(self, customers: np.ndarray, room: np.ndarray, base: np.ndarray, totals: np.ndarray, discount: float,
                 rng: np.random.Generator) -> None:
        """``room``: restaurant of each dish; ``base``: its parent probability;
        ``totals``: tables of each restaurant, kept up to date (one a dish so far)."""
        self.customers, self.room, self.base, self.totals, self.discount, self.rng = customers, room, base, totals, discount, rng
        self.sizes = np.zeros((len(customers), 4), dtype=np.int64)
        self.sizes[:, 0] = 1
        self.placed = np.ones(len(customers), dtype=np.int64)
        self.rows = np.arange(len(customers))

    @property
    def tables(self) -> np.ndarray:
        return (self.sizes > 0).sum(axis=1)

    def _fresh(self, rows: np.ndarray) -> np.ndarray:
        return (STRENGTH + self.discount * self.totals[self.room[rows]]) * self.base[rows]

    def _pick(self, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
        total = np.cumsum(weights, axis=1)
        x = np.minimum(x, total[:, -1] * (1 - 1e-12))
        return (total <= x[:, None]).sum(axis=1)

    def sit(self, rows: np.ndarray) -> None:
        """One more customer of each dish in ``rows``."""
        weights = np.maximum(self.sizes[rows] - self.discount, 0)
        old, fresh = weights.sum(axis=1), self._fresh(rows)
        x = self.rng.random(len(rows)) * (old + fresh)
        new = (x < fresh) | (old <= 0)
        join = ~new
        if join.any():
            at = self._pick(weights[join], (x - fresh)[join])
            self.sizes[rows[join], at] += 1
        if new.any():
            opened = rows[new]
            if (self.sizes[opened] > 0).all(axis=1).any():
                self.sizes = np.pad(self.sizes, ((0, 0), (0, self.sizes.shape[1])))
            self.sizes[opened, np.argmin(self.sizes[opened] > 0, axis=1)] = 1
            self.totals += np.bincount(self.room[opened], minlength=len(self.totals))
        self.placed[rows] += 1

    def _next_new(self, rows: np.ndarray) -> np.ndarray:
        """The customer of each dish in ``rows`` that opens the next table (one more
        than all of them: none does), when they sit down one after the other by the
        predictive rule. Of the waiting time the distribution is known (a ratio of
        gamma functions, bisected); it asks for the number of tables, not their sizes."""
        now, last = self.placed[rows], self.customers[rows]
        start, fresh = now - self.discount * self.opened[rows], self._fresh(rows)
        chance = np.log1p(-self.rng.random(len(rows)))
        if len(rows) <= FEW:
            return np.array([_wait(*x) for x in zip(now.tolist(), last.tolist(), start.tolist(), fresh.tolist(), chance.tolist())])
        offset = log_gamma(start + fresh) - log_gamma(start) - chance

        def joined(upto: np.ndarray, of: np.ndarray) -> np.ndarray:
            x = start[of] + (upto - now[of])
            return log_gamma(x) - log_gamma(x + fresh[of]) + offset[of] >= 0
        every = np.arange(len(rows))
        out = np.where(joined(last, every), last + 1, 0)
        low, high, step = now.copy(), last.copy(), 1
        at = every[out == 0]
        while len(at):  # waiting times are mostly short: steps that double find a bound from above
            upto = np.minimum(now[at] + step, last[at])
            more = joined(upto, at) & (upto < last[at])
            low[at[more]] = upto[more]
            high[at[~more]] = upto[~more]
            at, step = at[more], 2 * step
        at = every[(out == 0) & (high - low > 1)]
        while len(at):
            middle = (low[at] + high[at]) // 2
            stay = joined(middle, at)
            low[at[stay]] = middle[stay]
            high[at[~stay]] = middle[~stay]
            at = at[high[at] - low[at] > 1]
        return np.where(out == 0, np.maximum(high, now + 1), out)

    def _fill(self, dish: np.ndarray, when: np.ndarray) -> None:
        """Sizes of the tables, given the customer ``when`` that opened each table
        past the ones there are. From the last table to the first: of the joins
        after its opening that go to it or to an earlier table, the table's share is
        a beta variable (an urn of two colours), and the others go on to the earlier ones."""
        order = np.argsort(dish, kind="stable")  # by dish, in the order of opening
        dish, when = dish[order], when[order]
        first = np.searchsorted(dish, self.rows)
        many = np.searchsorted(dish, self.rows, side="right") - first
        old = (self.sizes > 0).sum(axis=1)
        width = int((old + many).max())
        if width > self.sizes.shape[1]:
            self.sizes = np.pad(self.sizes, ((0, 0), (0, width - self.sizes.shape[1])))
        here = self.sizes.sum(axis=1)
        after, upto = np.zeros(len(self.rows), dtype=np.int64), self.customers.copy()
        for k in range(int(many.max()) - 1, -1, -1):
            rows = self.rows[many > k]
            opening = when[first[rows] + k]
            joins = after[rows] + upto[rows] - opening
            rest = opening - 1 - self.discount * (old[rows] + k)
            mine = self.rng.binomial(joins, self.rng.beta(1 - self.discount, rest))
            self.sizes[rows, old[rows] + k] = 1 + mine
            after[rows], upto[rows] = joins - mine, opening - 1
        joins = after + upto - here
        rows = self.rows[joins > 0]
        share = self.rng.standard_gamma(np.maximum(self.sizes[rows] - self.discount, 0) * (np.arange(self.sizes.shape[1]) < old[rows, None]))
        share[share.sum(axis=1) <= 0, 0] = 1.0
        self.sizes[rows] += self.rng.multinomial(joins[rows], share / share.sum(axis=1, keepdims=True))

    def first(self) -> None:
        """Everybody sits down, one after the other, by the rule alone (``start`` thins
        what it opens); tables stay at the left."""
        while len(rows := self.rows[(self.placed < self.customers) & (self.placed < ONE_BY_ONE)]):
            self.sit(rows)
        rows = self.rows[self.placed < self.customers]
        if not len(rows):
            return
        self.opened, dish, when = self.tables, [], []
        while len(rows):
            new = self._next_new(rows)
            opens = new <= self.customers[rows]
            self.placed[rows] = np.minimum(new, self.customers[rows])
            rows, new = rows[opens], new[opens]
            self.opened[rows] += 1
            self.totals += np.bincount(self.room[rows], minlength=len(self.totals))
            dish.append(rows)
            when.append(new)
            rows = rows[new < self.customers[rows]]
        self._fill(np.concatenate(dish), np.concatenate(when))

    def start(self) -> None:
        """A seating to sweep from. By the rule alone a dish would open far more tables than
        it has given all its customers: each table makes every later customer's own
        likelihood smaller, by the ratio that an opening is thinned with here."""
        d = self.discount
        for row in self.rows.tolist():
            customers, base, room = int(self.customers[row]), float(self.base[row]), self.room[row]
            others, opened, now, when = int(self.totals[room]) - 1, 1, 1, []
            while now < customers:
                fresh = (STRENGTH + d * (others + opened)) * base
                now = _wait(now, customers, now - d * opened, fresh, math.log1p(-self.rng.random()))
                shift = fresh - d * opened
                if now <= customers and self.rng.random() < ((now + shift) / (customers + shift)) ** (d * (1 - base)):
                    when.append(now)
                    opened += 1
            self.totals[room] = others + opened
            self._keep(row, self._dealt(np.ones(1, dtype=np.int64), 1, customers - 1, [x - 2 for x in when]))

    def _keep(self, row: int, sizes: np.ndarray) -> None:
        if len(sizes) > self.sizes.shape[1]:
            self.sizes = np.pad(self.sizes, ((0, 0), (0, len(sizes))))
        self.sizes[row] = 0
        self.sizes[row, :len(sizes)] = sizes

    def _dealt(self, stay: np.ndarray, there: int, n: int, new: list[int]) -> np.ndarray:
        """Sizes of the tables when ``n`` customers have come to ``there`` others at the
        tables ``stay``, those at the places ``new`` opening tables; as in ``_fill``."""
        joins, last, fresh_sizes = 0, n, []
        for k in range(len(new) - 1, -1, -1):
            joins += last - new[k] - 1
            mine = int(self.rng.binomial(joins, self.rng.beta(1 - self.discount, there + new[k] - self.discount * (len(stay) + k))))
            fresh_sizes.append(1 + mine)
            joins, last = joins - mine, new[k]
        share = self.rng.standard_gamma(stay - self.discount)
        share = share / share.sum() if share.sum() > 0 else np.full(len(stay), 1 / len(stay))
        return np.concatenate([stay + self.rng.multinomial(joins + last, share), np.array(fresh_sizes, dtype=np.int64)])

    def sweep(self) -> None:
        """As many customers of each dish as it has get up and sit down again, in blocks."""
        for row in self.rows.tolist():
            sizes, room = self.sizes[row][self.sizes[row] > 0], self.room[row]
            others = int(self.totals[room]) - len(sizes)
            sizes = self._reseat(sizes, int(self.customers[row]), float(self.base[row]), others)
            self.totals[room] = others + len(sizes)
            self._keep(row, sizes)

    def _reseat(self, sizes: np.ndarray, customers: int, base: float, others: int) -> np.ndarray:
        """Table sizes of one dish after its sweep. A block's customers, drawn at
        random, sit down again by the predictive rule; the seating that they leave
        and the new one are weighed by the product of the rule's sums. The size of a
        block follows from what its moves do not change, and keeps these close."""
        d, rng = self.discount, self.rng
        expected = (STRENGTH + d * others) * base / max(1 - base, 1e-3)
        block = max(1, int(customers * min(0.5, (0.5 / (d * math.sqrt(max(expected, 1e-9)))) ** (2 / 3))))
        moved = 0
        while moved < customers:
            gone = rng.binomial(sizes, block / customers)
            n = int(gone.sum())
            if n in (0, customers):
                continue
            moved += n
            stay = sizes - gone
            closed, stay = sizes[stay == 0], stay[stay > 0]
            was = np.zeros(0, dtype=np.int64)
            if len(closed):  # they open again with the first of their customers, in an order drawn at random
                places = rng.choice(n, int(closed.sum()), replace=False)
                was = np.sort(np.minimum.reduceat(places, np.cumsum(closed) - closed))
            now, opened, new = customers - n, len(stay), []
            while now < customers:
                fresh = (STRENGTH + d * (others + opened)) * base
                now = _wait(now, customers, now - d * opened, fresh, math.log1p(-rng.random()))
                if now <= customers:
                    new.append(now - 1 - (customers - n))
                    opened += 1
            weight = [self._rule_sums(customers - n, n, len(stay), np.asarray(x, dtype=np.int64), base, others) for x in (new, was)]
            if math.log1p(-rng.random()) > weight[0] - weight[1]:
                continue
            sizes = self._dealt(stay, customers - n, n, new)
        return sizes

    def _rule_sums(self, there: int, n: int, tables: int, opens: np.ndarray, base: float, others: int) -> float:
        """Logarithm of the product of the rule's sums over ``n`` customers that come
        to ``there`` others, those at the places ``opens`` opening a table."""
        t = tables + np.arange(len(opens) + 1)
        shift = there - self.discount * t + (STRENGTH + self.discount * (others + t)) * base
        low, high = np.append(0, opens + 1), np.append(opens + 1, n)
        return float((log_gamma(high + shift) - log_gamma(low + shift)).sum())


_STIRLING: dict[tuple[float, int], np.ndarray] = {}


def log_stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: of ``c`` customers (row) at ``t``
    tables (column), the sum over all seatings of the tables' weights."""
    if (discount, most) not in _STIRLING:
        out = np.full((most + 1, most + 1), -np.inf)
        out[0, 0] = 0.0
        t = np.arange(1, most + 1)
        with np.errstate(divide="ignore"):
            for c in range(most):
                join = np.log(np.maximum(c - discount * t[:c], 0))
                out[c + 1, 1:c + 1] = np.logaddexp(out[c, :c], out[c, 1:c + 1] + join)
                out[c + 1, c + 1] = out[c, c]
        _STIRLING.clear()
        _STIRLING[discount, most] = out
    return _STIRLING[discount, most]


class Counts:
    """Tables of dishes of few customers, all of them seated anew in a sweep: a dish's
    number of tables is drawn from its distribution given the other dishes' tables."""

    def __init__(self, customers: np.ndarray, room: np.ndarray, base: np.ndarray, totals: np.ndarray, discount: float,
                 rng: np.random.Generator) -> None:
        self.customers, self.room, self.base, self.totals, self.discount, self.rng = customers, room, base, totals, discount, rng
        self.tables = np.ones(len(customers), dtype=np.int64)
        self.seats = log_stirling(discount, max(DIRECT, int(customers.max())))
        order = np.argsort(customers, kind="stable")
        cuts = np.nonzero(np.diff(customers[order], prepend=0, append=0))[0]
        self.steps = []
        for lo, hi in zip(cuts, cuts[1:]):
            many = max(1, CELLS // int(customers[order[lo]]))
            self.steps += [order[a:min(a + many, hi)] for a in range(lo, hi, many)]

    def sweep(self) -> None:
        for at in self.steps:
            c, room, own = int(self.customers[at[0]]), self.room[at], self.tables[at]
            x = (self.totals[room] - own)[:, None] + np.arange(c)  # tables in the room before each new one
            x = np.log((STRENGTH + self.discount * x) * np.maximum(self.base[at], 1e-300)[:, None])
            np.cumsum(x, axis=1, out=x)
            x += self.seats[c, 1:c + 1]
            x -= x.max(axis=1, keepdims=True)
            np.cumsum(np.exp(x, out=x), axis=1, out=x)
            chosen = self.rng.random(len(at)) * x[:, -1]
            self.tables[at] = 1 + np.minimum((x <= chosen[:, None]).sum(axis=1), c - 1)
            self.totals += np.bincount(room, weights=self.tables[at] - own, minlength=len(self.totals)).astype(np.int64)

    start = sweep


def sample_tables(customers: np.ndarray, room: np.ndarray, base: np.ndarray, totals: np.ndarray, discount: float,
                  rng: np.random.Generator, samples: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tables of each dish and of each restaurant in ``samples`` seatings.
    ``totals``: tables of the restaurants with one for each dish. A single
    customer sits alone; of the others all are seated anew in a sweep, one
    before each seating that is kept."""
    classes, low = [], DIRECT + 1
    at = np.nonzero((customers >= 2) & (customers <= DIRECT))[0]
    if len(at):
        classes.append((at, Counts(customers[at], room[at], base[at], totals, discount, rng)))
    while len(customers) and low <= customers.max():
        at = np.nonzero((customers >= low) & (customers < 2 * low))[0]
        if len(at):
            classes.append((at, Seating(customers[at], room[at], base[at], totals, discount, rng)))
        low *= 2
    for _, s in classes:
        s.start()
    out = []
    for _ in range(samples):
        tables = np.minimum(customers, 1)
        for at, s in classes:
            s.sweep()
        for at, s in classes:
            tables[at] = s.tables
        out.append((tables, totals.copy()))
    return out


def discount_of(ones: float, twos: float) -> float:
    """The usual estimate from dishes with one and two customers."""
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones + twos > 0 else 0.5


class Root:
    """Totals of the shared parent: known words, and per seating its customers and tables,
    and the tables that each word part has of them."""

    def __init__(self, words: float = 0, customers: list[float] = (), tables: list[float] = (), discount: float = 0.5,
                 parts: dict[int, list[float]] | None = None) -> None:
        self.words, self.customers, self.tables, self.discount, self.parts = words, list(customers), list(tables), discount, parts or {}

    def base(self) -> float:
        return 1.0 / (self.words + 1)

    def probability(self, s: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        weight = STRENGTH + self.customers[s]
        return np.maximum(customers - self.discount * tables, 0) / weight + (STRENGTH + self.discount * self.tables[s]) / weight * self.base()


# ---------------------------------------------------------------- stages

def _rows(out: list[tuple]) -> pa.Table:
    kind, at, src, body, sums = zip(*out) if out else ((),) * 5
    return pa.table({"kind": pa.array(kind, pa.int32()), "at": pa.array(at, pa.int64()), "src": pa.array(src, pa.int64()),
                     "body": pa.array(body, pa.binary()), "sums": pa.array(sums, pa.list_(pa.float64()))})


def _bodies(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """(src, body) of the group's rows of a kind, by src."""
    picked = [(s, b) for k, s, b in zip(table["kind"].to_pylist(), table["src"].to_pylist(), table["body"].to_pylist()) if k == kind]
    return sorted(picked, key=lambda x: x[0])


def _word_part(words: np.ndarray, parts: int) -> np.ndarray:
    """Part of each word: equal ranges of the sorted hashes."""
    return ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _asks(bucket: int, r: Restaurants, counts: list[np.ndarray], parts: int) -> list[tuple]:
    part = _word_part(r.words, parts)
    cuts = np.nonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))[0] if len(part) else []
    return [(ASK, int(part[lo]), bucket, frame(r.words[lo:hi], *[small(c[lo:hi]) for c in counts]), None) for lo, hi in zip(cuts, cuts[1:])]


def _told(table: pa.Table, n: int) -> list[np.ndarray]:
    """Columns that the word parts answered, in the order of the bucket's words."""
    columns: list[list[np.ndarray]] = []
    for _, body in _bodies(table, TELL):
        size, *raw = unframe(body, np.uint64, *[np.uint8] * 99)
        columns.append([unsmall(x, int(size[0])) for x in raw])
    return [np.concatenate(c) for c in zip(*columns)] if columns else [np.zeros(n, np.int64)] * 99


def pack_stage(docs: DataFrame, split: np.ndarray, buckets: int, with_docs: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, held, texts in _buffers(batches):
            blocks, own = pack_pairs(texts, held, split, buckets, with_docs)
            out = [(PAIRS, bucket, number, body, None) for bucket, body in blocks]
            if own:
                sink = pa.BufferOutputStream()
                batch = pa.RecordBatch.from_arrays([ids, pa.array(held)], names=["doc_id", "held_out"])
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch)
                out.append((DOCS, -1 - number, number, frame(np.frombuffer(sink.getvalue(), np.uint8), np.frombuffer(own, np.uint8)), None))
            for lo in range(0, len(out), 64):
                yield from _rows(out[lo:lo + 64]).to_batches()
    return docs.mapInArrow(run, MESSAGE)


def contexts_stage(docs: DataFrame) -> tuple[int, np.ndarray]:
    """All tokens, and the contexts to split: a context with 1 / 512 of all tokens
    has 1 / 2048 of some buffer's, where it is counted, and loses less than a
    quarter of itself in the buffers where it is not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, texts in _buffers(batches):
            u = np.sort(sequences(texts)[0])
            at = np.nonzero(np.concatenate([[True], u[1:] != u[:-1]]))[0]
            n = np.diff(np.append(at, len(u)))
            often = n * 2048 >= len(u)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(u[at][often], 0).view(np.int64)), pa.array(np.append(n[often], len(u)))], names=["u", "n"])
    counts = stored(docs.mapInArrow(run, "u long, n long").groupBy("u").agg(F.sum("n").alias("n")))
    tokens = counts.where("u = 0").agg(F.sum("n")).first()[0] or 0
    hot = [x.u for x in counts.where(F.col("u") != 0).where(F.col("n") * 683 >= tokens).select("u").collect()]  # at most 683
    return tokens, np.sort(np.array(hot, dtype=np.int64).view(np.uint64))


def first_bucket(buckets: int, split: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """Every dish at one table."""
    def run(table: pa.Table) -> pa.Table:
        r = Restaurants([b for _, b in _bodies(table, PAIRS)])
        tables = np.minimum(r.customers, 1)
        out = _asks(table["at"][0].as_py(), r, [r.per_word(r.customers), r.per_word(tables)], buckets)
        out.append((TOTALS, 0, 0, None, [float((r.customers == 1).sum()), float((r.customers == 2).sum())]))
        return _rows(out + _split_totals(r, [tables], split))
    return run


def _split_totals(r: Restaurants, tables: list[np.ndarray], split: np.ndarray) -> list[tuple]:
    mine = np.nonzero(np.isin(r.contexts, split))[0]
    sums = [r.per_context(x) for x in (r.customers, *tables)]
    return [(SPLIT, int(r.contexts[i].view(np.int64)), 0, None, [float(x[i]) for x in sums]) for i in mine]


class Split:
    """Totals of the split contexts over all buckets, from the round before."""

    def __init__(self, contexts: np.ndarray, totals: dict[int, list[float]]) -> None:
        self.contexts, self.totals = contexts, totals

    def whole(self, r: Restaurants, column: int, local: np.ndarray) -> np.ndarray:
        out = local.copy()
        for i in np.nonzero(np.isin(r.contexts, self.contexts))[0]:
            out[i] = self.totals[int(r.contexts[i].view(np.int64))][column]
        return out


def sample_bucket(buckets: int, root: Root, split: Split, discount: float, samples: int, seed: int) -> Callable[[pa.Table], pa.Table]:
    """Seat all customers under the root of the round before."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table["at"][0].as_py()
        r = Restaurants([b for _, b in _bodies(table, PAIRS)])
        _, *told = _told(table, len(r.words))
        last = len(root.customers) - 1
        base = root.probability(last, told[2 * last], told[2 * last + 1])
        own = r.per_context(np.minimum(r.customers, 1))
        totals = split.whole(r, -1, own).astype(np.int64)  # a split context: its tables elsewhere as of the last round
        got = sample_tables(r.customers, r.context, base[r.word], totals, discount, np.random.default_rng([seed, bucket]), samples)
        seats = [t for t, _ in got]
        out = _asks(bucket, r, [r.per_word(r.customers), *[r.per_word(t) for t in seats]], buckets)
        many = r.customers >= 2
        out.append((SEATS, bucket, 0, frame(*[small(t[many] - 1) for t in seats]), None))
        return _rows(out + _split_totals(r, seats, split.contexts))
    return run


def count_words(table: pa.Table) -> pa.Table:
    """Distinct words of a word part."""
    words = [unframe(body, np.uint64)[0] for _, body in _bodies(table, ASK)]
    return _rows([(TOTALS, 0, 0, None, [float(len(np.unique(np.concatenate(words))))])])


def seat_root(root: Root, seed: int) -> Callable[[pa.Table], pa.Table]:
    """The parent's customers are the tables of all buckets; answers each bucket
    with its words' training tokens and, per seating, root customers and tables."""
    def run(table: pa.Table) -> pa.Table:
        part = table["at"][0].as_py()
        asked = []
        for src, body in _bodies(table, ASK):
            words, *raw = unframe(body, np.uint64, *[np.uint8] * 99)
            asked.append((src, words, [unsmall(x, len(words)) for x in raw]))
        words, at = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
        sums = [np.bincount(at, weights=np.concatenate(x), minlength=len(words)).astype(np.int64) for x in zip(*[a[2] for a in asked])]
        columns, totals = [sums[0]], [float((sums[0] > 0).sum()), float(sums[0].sum()), float((sums[1] == 1).sum()), float((sums[1] == 2).sum())]
        room = np.zeros(len(words), dtype=np.int64)
        for s, customers in enumerate(sums[1:]):
            # the root's tables: one for each word here, and those of the other parts as of the last round (first: one a word)
            last = min(s, len(root.tables) - 1)
            elsewhere = root.tables[last] - root.parts[part][last] if root.tables else root.words - len(words)
            whole = np.array([int(elsewhere) + len(words)], dtype=np.int64)
            (tables, _), = sample_tables(customers, room, np.full(len(words), root.base()), whole, root.discount, np.random.default_rng([seed, s, part]), 1)
            columns += [customers, tables]
            totals += [float(customers.sum()), float(tables.sum())]
        out, lo = [(TOTALS, part, 0, None, totals)], 0
        for src, own, _ in asked:
            mine = at[lo:lo + len(own)]
            lo += len(own)
            out.append((TELL, src, part, frame(np.array([len(own)], np.uint64), *[small(c[mine]) for c in columns]), None))
        return _rows(out)
    return run


def score_bucket(root: Root, split: Split, discount: float, tokens: float) -> Callable[[pa.Table], pa.Table]:
    """Probabilities of the bucket's pairs, summed per document of each buffer."""
    samples = len(root.customers)

    def run(table: pa.Table) -> pa.Table:
        if table["kind"][0].as_py() == DOCS:  # the buffer's own row: on to the last stage
            return table
        blocks = _bodies(table, PAIRS)
        if not blocks:
            return _rows([])
        r = Restaurants([b for _, b in blocks])
        train, *told = _told(table, len(r.words))
        many = r.customers >= 2
        raw = [unframe(b, *[np.uint8] * samples) for _, b in _bodies(table, SEATS)]
        visits = split.whole(r, 0, r.per_context(r.customers))[r.context]
        chance = np.zeros(len(r.key))
        for s in range(samples):
            tables = np.minimum(r.customers, 1)
            if raw:
                tables[many] = unsmall(raw[0][s], int(many.sum())) + 1
            opened = split.whole(r, 1 + s, r.per_context(tables))[r.context]
            above = root.probability(s, told[2 * s], told[2 * s + 1])[r.word]
            chance += (np.maximum(r.customers - discount * tables, 0) + (STRENGTH + discount * opened) * above) / (STRENGTH + visits)
        value = np.log10(chance / samples)
        base = np.log10((train + 0.5) / (tokens + 0.5 * (root.words + 1)))[r.word]
        known = (train > 0)[r.word]
        out, lo = [], 0
        for (src, body), n in zip(blocks, r.sizes):
            _, _, _, raw_lists, docs = unpack_pairs(body)
            pair = r.of_block[lo:lo + n]
            lo += n
            lists = unsmall(raw_lists, n)
            often = pair[lists == 0]
            each = np.repeat(pair, lists)
            there, at = np.unique(docs, return_inverse=True)
            sums = [np.bincount(at, weights=x[each], minlength=len(there)) for x in (value, base, known)]
            out.append((SCORES, 0, src, frame(there, sums[0], sums[1], small(sums[2].astype(np.int64)),
                                              r.key[often], value[often], base[often], known[often]), None))
        return _rows(out)
    return run


def sum_documents(table: pa.Table) -> pa.Table:
    """A buffer's documents with the sums from all buckets."""
    (_, body), = _bodies(table, DOCS)
    stream, raw = unframe(body, np.uint8, np.uint8)
    batch = pa.ipc.open_stream(pa.py_buffer(stream.tobytes())).read_all()
    n, keys, tokens, docs = unframe(raw.tobytes(), np.int64, np.uint64, np.uint32, np.uint16)
    sums = np.zeros((3, len(n)))
    order = np.argsort(keys)
    values = np.zeros((3, len(keys)))
    for _, body in _bodies(table, SCORES):
        there, score, base, known, often, *their = unframe(body, np.uint16, np.float64, np.float64, np.uint8, np.uint64, np.float64, np.float64, np.bool_)
        for i, x in enumerate((score, base, unsmall(known, len(there)))):
            sums[i, there] += x
        if len(often):
            at = order[np.searchsorted(keys, often, sorter=order)]
            for i, x in enumerate(their):
                values[i, at] = x
    for i in range(3):
        sums[i] += np.bincount(docs, weights=np.repeat(values[i], tokens), minlength=len(n))
    return pa.table({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "n_tokens": pa.array(n), "n_known": pa.array(np.rint(sums[2]).astype(np.int64)),
                     "base_score": pa.array(sums[1]), "score": pa.array(sums[0])})


# ---------------------------------------------------------------- the model

def _kept(df: DataFrame) -> DataFrame:
    """Messages written to the shared folder with one subfolder a kind."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "llm")
    df.write.mode("overwrite").partitionBy("kind").parquet(path)
    release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def _drop(df: DataFrame, kind: int) -> None:
    """Deletes the messages of a kind that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{df._stored_path}/kind={kind}")
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _sums(df: DataFrame, kind: int, by: str | None = None) -> list:
    """Element sums of ``sums`` over the rows of a kind (a few totals, or one row a split context)."""
    rows = df.where(F.col("kind") == kind)
    width = (rows.agg(F.max(F.size("sums"))).first()[0]) or 0
    columns = [F.coalesce(F.sum(F.col("sums")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(width)]
    if not columns:
        return []
    return (rows.groupBy(by).agg(*columns) if by else rows.agg(*columns)).collect()


def score_documents(docs: DataFrame, column: str = "text", rounds: int = ROUNDS, samples: int = SAMPLES, seed: int = 11) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-half unigram) and ``score`` (the model), log10, per row."""
    prepare(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held"), F.coalesce(F.col(column), F.lit("")).alias("t"))
    tokens, contexts = contexts_stage(docs)
    buckets = max(1, -(-tokens // BUCKET_TOKENS))

    def by_bucket(*tables: DataFrame) -> object:
        out = tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out.groupBy("at")
    pairs = pack_stage(docs, contexts, buckets, False)
    asks = _kept(by_bucket(pairs).applyInArrow(first_bucket(buckets, contexts), MESSAGE))
    discount = discount_of(*(_sums(asks, TOTALS) or [(0, 0)])[0])
    counted = _sums(by_bucket(asks.where(F.col("kind") == ASK)).applyInArrow(count_words, MESSAGE), TOTALS)
    root, n_tokens = Root(counted[0][0] if counted else 0), 0.0
    for k in range(rounds + 1):
        split = Split(contexts, {x[0]: list(x[1:]) for x in _sums(asks, SPLIT, "at")})
        tells = _kept(by_bucket(asks.where(F.col("kind") == ASK)).applyInArrow(seat_root(root, seed + 100 * k), MESSAGE))
        sums = {x[0]: x[1:] for x in _sums(tells, TOTALS, "at")}  # one row a word part
        words, n_tokens, ones, twos, *rest = map(sum, zip(*sums.values())) if sums else (0.0,) * 6
        root = Root(words, rest[::2], rest[1::2], discount_of(ones, twos), {part: x[5::2] for part, x in sums.items()})
        _drop(asks, ASK)
        if k == rounds:
            break
        asks = _kept(by_bucket(pairs, tells.where(F.col("kind") == TELL)).applyInArrow(
            sample_bucket(buckets, root, split, discount, samples if k == rounds - 1 else 1, seed + 100 * k + 50), MESSAGE))
        discard(tells)
    postings = pack_stage(docs, contexts, buckets, True)
    sums = by_bucket(postings, tells.where(F.col("kind") == TELL), asks.where(F.col("kind") == SEATS)).applyInArrow(
        score_bucket(root, split, discount, n_tokens), MESSAGE)
    return (sums.groupBy("src").applyInArrow(sum_documents, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
                                                            "base_score double, score double")
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n_tokens)).cast("long").alias("train_tokens"), "base_score", "score"))
