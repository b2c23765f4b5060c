"""Language model scores by a hierarchical Pitman-Yor process.

The context of a token is the word before it, and every such word has a restaurant of its own, so their number grows
with the corpus. Its parent is the restaurant of a class of words (one of `FINE`, by hash), which only smooths: the
parents of these are `COARSE` wider classes, then the root, which draws from a uniform base over the known tokens and
one for all unknown ones.

All restaurants that serve a word are seated where that word's counts meet, so a word is the unit of the seating. What
a restaurant sums over all words travels between the tasks: first the customers and distinct words of each context, as
rough totals to draw with; then the drawn tables, to the tasks of the contexts, where the texts' tokens are scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from tidymart.session import drop_written, written

FINE, COARSE = 256, 16
#: The tokens after a word with at least 1 / FREQUENT of the training tokens are scored in many tasks, not in one.
FREQUENT = 4_096
TOKENS_IN_TASK = 1_500_000
TOKENS_AT_ONCE = 1_000_000
#: The most frequent contexts travel as two bytes each, all others as their hash; this bounds the list, not the contexts.
IN_BOOK = (1 << 16) - 1
_CLASS = np.uint64(FINE - 1)  # the low bits of a word are 0 and have room for a class of contexts
END = np.uint64(0xA0761D6478BD6400)
START = np.uint64(0xE7037ED1A0B42800)  # the context of a text's first token
_START_CLASS = 0
EXACT = 256  # customers of a dish whose tables are drawn from their exact distribution
_AT_ONCE = 1 << 20  # cells of the matrix of such distributions


@dataclass(frozen=True)
class Process:
    """Discounts and strengths from the root over the classes to the words; sweeps before and between samples."""

    discounts: tuple[float, float, float, float] = (0.5, 0.6, 0.75, 0.8)
    strengths: tuple[float, float, float, float] = (50.0, 20.0, 10.0, 2.0)
    burn_in: int = 2
    samples: int = 2
    seed: int = 3
    folds: int = 7
    held_out: int = 2


def held_out(id_column: str = "doc_id", process: Process = Process()):
    remainder = F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(process.folds))
    return remainder == process.held_out


def tokens(column: pa.Array):
    """Chunks of texts: first row, the tokens, their contexts, and the number of tokens before each text.

    A text's tokens are its words and one end, as 56-bit hashes. The context of a token is the word before it.
    """
    for a, _, data, starts in words.chunks(column):
        hashes, first = words.word_hashes(data, starts)
        total = first + np.arange(len(starts))
        is_end = np.zeros(total[-1], bool)
        is_end[total[1:] - 1] = True
        token = np.full(total[-1], END)
        token[~is_end] = hashes & ~_CLASS
        context = np.empty(total[-1], np.uint64)
        context[1:] = token[:-1]
        context[total[:-1]] = START
        yield a, token, context, total


def classes(context: np.ndarray) -> np.ndarray:
    """The class of each context, the parent of its restaurant."""
    return np.where(context == START, _START_CLASS, (np.uint64(1) + (context >> np.uint64(40)) % np.uint64(FINE - 1)).astype(np.int64))


def pairs(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """64-bit value of a word after a context."""
    return words.mix(word + words.mix(context))


def _uniform(words_: np.ndarray, places: np.ndarray, draw: int) -> np.ndarray:
    """A number in (0, 1) that depends on word, restaurant and draw alone, so every pass draws the same."""
    salt = np.uint64(draw * 0x9E3779B97F4A7C15 % (1 << 64))
    mixed = words.mix(words_ + words.mix(places.astype(np.uint64) + salt))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


@lru_cache(maxsize=8)
def _ways(discount: float) -> np.ndarray:
    """Log of the weight of all seatings of c customers at t tables of one dish, at [c, t], up to `EXACT` customers.

    These are the generalised Stirling numbers: one more customer joins t tables of c customers with weight
    c - discount * t, or opens a table.
    """
    ways = np.full((EXACT + 1, EXACT + 1), -np.inf)
    ways[1, 1] = 0.0
    for c in range(1, EXACT):
        t = np.arange(1, c + 2)
        joined = np.full(c + 1, -np.inf)
        joined[:-1] = ways[c, 1 : c + 1] + np.log(c - discount * t[:-1])
        ways[c + 1, 1 : c + 2] = np.logaddexp(joined, ways[c, : c + 1])
    return ways


def seat(customers, open_weight, discount, words_, places, draw):
    """The number of tables of each (restaurant, dish), drawn from its conditional given the others.

    With the weight `open_weight` of a new table, c customers of a dish sit at t tables with a probability in
    proportion to open_weight ** t times the weight of all such seatings, so the number is drawn from this
    distribution at once, whatever it was before. Up to `EXACT` customers it is exact; for more, its limit form is
    drawn: one table and a Poisson number of others.
    """
    if not len(customers):
        return np.zeros(0)
    customers = customers.astype(np.int64)
    tables = np.minimum(customers, 1).astype(np.float64)
    chance = _uniform(words_, places, draw * 4096)
    ways, first = _ways(discount), np.minimum(customers, EXACT)
    order = np.argsort(first, kind="stable")
    counts, begins = np.unique(first[order], return_index=True)
    for c, a, b in zip(counts.tolist(), begins.tolist(), np.append(begins[1:], len(order)).tolist(), strict=True):
        if c < 2:
            continue
        t = np.arange(1, c + 1)
        rows = max(1, _AT_ONCE // c)
        for mine in (order[i : min(i + rows, b)] for i in range(a, b, rows)):
            log = ways[c, 1 : c + 1] + np.log(open_weight[mine])[:, None] * t
            sums = np.cumsum(np.exp(log - log.max(1, keepdims=True)), 1)
            tables[mine] = np.minimum((sums <= (chance[mine] * sums[:, -1])[:, None]).sum(1) + 1, c)
    many = customers > EXACT
    if many.any():
        more = _others(customers[many], open_weight[many], discount)
        u, v = chance[many], _uniform(words_[many], places[many], draw * 4096 + 1)
        tables[many] = np.minimum(1 + _poisson(more, u, v), customers[many])
    return tables


def _others(customers, open_weight, discount):
    """Mean number of tables besides the first for many customers.

    The numbers of customers and tables have the generating function exp(open_weight * f(x)) with
    f(x) = (1 - (1 - x) ** discount) / discount. Given x, the tables are a Poisson number of mean open_weight * f(x);
    x is where the mean number of customers is the given one. As customers grow the mean nears open_weight / discount.
    """
    low, high = np.full(len(customers), -60.0), np.zeros(len(customers))  # log of 1 - x
    for _ in range(60):
        middle = (low + high) / 2
        few = open_weight * -np.expm1(middle) * np.exp(middle * (discount - 1)) < customers
        low, high = np.where(few, low, middle), np.where(few, middle, high)
    f = -high if discount == 0 else -np.expm1(high * discount) / discount
    return open_weight * f


def _poisson(mean, u, v):
    """Poisson numbers from uniform ones: by the distribution up to a mean of 50, beyond by the normal one."""
    found = np.maximum(0.0, np.floor(mean + np.sqrt(-2 * np.log(u) * mean) * np.cos(2 * np.pi * v) + 0.5))
    small = np.flatnonzero(mean <= 50)
    term = np.exp(-mean[small])
    total, k = term.copy(), np.zeros(len(small))
    for i in range(1, 200):
        over = u[small] > total
        if not over.any():
            break
        k += over
        term = term * mean[small] / i
        total += term
    found[small] = k
    return found


class Seating:
    """The restaurants of some words: fine counts given, tables sampled upwards; `totals` are of all words."""

    def __init__(self, word: np.ndarray, fine: np.ndarray, count: np.ndarray, process: Process, guess: Guess):
        """Rows are the distinct (word, fine class) in ascending order with their training counts, none 0."""
        self.p, self.guess = process, guess
        self.word, self.fine, self.count = word, fine.astype(np.int64), count.astype(np.float64)
        new = np.ones(len(word), bool)
        new[1:] = word[1:] != word[:-1]
        self.words = word[new]
        self.of = np.cumsum(new) - 1
        pair = self.of * COARSE + self.fine % COARSE
        self.pairs, self.up = np.unique(pair, return_inverse=True)
        self.pair_word = self.pairs // COARSE
        self.pair_class = self.pairs % COARSE
        self.states: list = [None, None, None]
        self.draw = 0

    def sweep(self) -> None:
        """From the fine restaurants up: tables of each level are the customers of the next."""
        p, g = self.p, self.guess
        self.draw += 1
        base = np.full(len(self.words), 1.0 / (g.known + 1))
        if self.states[0] is None:
            top = base
            middle = base[self.pair_word]
        else:
            top = self._root(base)
            middle = self._coarse(top)
        weights = (p.strengths[2] + p.discounts[2] * g.fine_tables[self.fine]) * middle[self.up]
        self.states[2] = seat(self.count, weights, p.discounts[2], self.word, self.fine + 64, self.draw)
        self.middle = np.bincount(self.up, self.states[2], len(self.pairs))
        weights = (p.strengths[1] + p.discounts[1] * g.coarse_tables[self.pair_class]) * top[self.pair_word]
        self.states[1] = seat(self.middle, weights, p.discounts[1], self.words[self.pair_word], self.pair_class, self.draw)
        self.root = np.bincount(self.pair_word, self.states[1], len(self.words))
        weights = (p.strengths[0] + p.discounts[0] * g.root_tables) * base
        self.states[0] = seat(self.root, weights, p.discounts[0], self.words, np.full(len(self.words), 32), self.draw)

    def _root(self, base):
        p, g = self.p, self.guess
        return ((self.root - p.discounts[0] * self.states[0]) + (p.strengths[0] + p.discounts[0] * g.root_tables) * base) / (g.root + p.strengths[0])

    def _coarse(self, top):
        p, g, c = self.p, self.guess, self.pair_class
        mine = self.middle - p.discounts[1] * self.states[1]
        return (mine + (p.strengths[1] + p.discounts[1] * g.coarse_tables[c]) * top[self.pair_word]) / (g.coarse[c] + p.strengths[1])

    def predicted(self) -> np.ndarray:
        """Probability of each row's word in its fine restaurant, under the present state and the guessed totals."""
        p, g, f = self.p, self.guess, self.fine
        middle = self._coarse(self._root(np.full(len(self.words), 1.0 / (g.known + 1))))
        mine = self.count - p.discounts[2] * self.states[2]
        return (mine + (p.strengths[2] + p.discounts[2] * g.fine_tables[f]) * middle[self.up]) / (g.fine[f] + p.strengths[2])

    def totals(self) -> np.ndarray:
        """Tables of each fine class, customers and tables of each coarse class, customers and tables of the root."""
        return np.concatenate(
            [
                np.bincount(self.fine, self.states[2], FINE),
                np.bincount(self.pair_class, self.middle, COARSE),
                np.bincount(self.pair_class, self.states[1], COARSE),
                [self.root.sum(), self.states[0].sum()],
            ]
        )

    def sampled(self):
        """After burn-in, once for each sample: the state is ready to be read."""
        for _ in range(self.p.burn_in):
            self.sweep()
        for _ in range(self.p.samples):
            self.sweep()
            yield


class Contexts:
    """The restaurants of contexts that serve some words, and all restaurants above them.

    The tables of a word in the contexts of a class are its customers in the restaurant of the class.
    """

    def __init__(self, word: np.ndarray, context: np.ndarray, count: np.ndarray, rough: np.ndarray, process: Process, guess: Guess):
        """Rows are the distinct (word, context) in ascending order with their training counts, none 0.

        `rough` is a guess of the tables of each row's context over all words; where a row has one customer it is not used.
        """
        self.p, self.word, self.context = process, word, context
        self.count, self.rough = count.astype(np.float64), rough.astype(np.float64)
        keys, self.up = np.unique(word | classes(context).astype(np.uint64), return_inverse=True)
        self.above = Seating(keys & ~_CLASS, keys & _CLASS, np.bincount(self.up, minlength=len(keys)), process, guess)
        self.tables = np.zeros(len(word))

    def sweep(self) -> None:
        """From the contexts up."""
        p, a = self.p, self.above
        parent = np.full(len(a.word), 1.0 / (a.guess.known + 1)) if a.states[0] is None else a.predicted()
        weights = (p.strengths[3] + p.discounts[3] * self.rough) * parent[self.up]
        self.tables = seat(self.count, weights, p.discounts[3], self.word, self.context, a.draw + 1)
        a.count = np.bincount(self.up, self.tables, len(a.word))
        a.sweep()

    def sampled(self):
        """After burn-in, once for each sample: the state is ready to be read."""
        for _ in range(self.p.burn_in):
            self.sweep()
        for _ in range(self.p.samples):
            self.sweep()
            yield

    def totals(self) -> np.ndarray:
        """Customers of each fine class, then the totals of the restaurants above."""
        return np.concatenate([np.bincount(self.above.fine, self.above.count, FINE), self.above.totals()])

    def state(self) -> list[bytes]:
        """Customers and tables of all levels, packed."""
        a = self.above
        return [_pack(c.astype("<u8")) for c in (self.tables, a.count, a.states[2], a.middle, a.states[1], a.root, a.states[0])]

    def restore(self, state: list[bytes]) -> None:
        a = self.above
        sizes = [len(self.word), *[len(a.word)] * 2, *[len(a.pairs)] * 2, *[len(a.words)] * 2]
        self.tables, a.count, fine, a.middle, coarse, a.root, root = (_unpack(c, "<u8", n).astype(np.float64) for c, n in zip(state, sizes, strict=True))
        a.states = [root, coarse, fine]


@dataclass
class Guess:
    """Totals over all words, as numbers the seating is made with; after a pass the sampled ones."""

    known: int
    fine: np.ndarray
    fine_tables: np.ndarray
    coarse: np.ndarray
    coarse_tables: np.ndarray
    root: float
    root_tables: float

    @staticmethod
    def before(fine: np.ndarray) -> Guess:
        """Rough shares before anything is sampled; they shape proposals and are replaced by sums for scoring."""
        tables = 0.3 * fine
        coarse = np.bincount(np.arange(FINE) % COARSE, tables, COARSE)
        return Guess(max(1, int(0.05 * fine.sum())), fine, tables, coarse, 0.3 * coarse, 0.3 * coarse.sum(), 0.15 * coarse.sum())

    @staticmethod
    def after(fine: np.ndarray, totals: np.ndarray, known: int) -> Guess:
        f, c, t = totals[:FINE], totals[FINE : FINE + COARSE], totals[FINE + COARSE : FINE + 2 * COARSE]
        return Guess(known, fine, f, c, t, float(totals[-2]), float(totals[-1]))


def probabilities(seating: Seating, guess: Guess, ask_word: np.ndarray, ask_fine: np.ndarray) -> np.ndarray:
    """Predictive probability of words after histories under the seating's present state and given totals."""
    p = seating.p
    base = 1.0 / (guess.known + 1)
    nothing = (p.strengths[0] + p.discounts[0] * guess.root_tables) * base / (guess.root + p.strengths[0])
    at = np.searchsorted(seating.words, ask_word)
    at[at == len(seating.words)] = 0
    known = seating.words[at] == ask_word if len(seating.words) else np.zeros(len(ask_word), bool)
    out = np.full(len(ask_word), nothing)
    if len(seating.words):
        own = (seating.root - p.discounts[0] * seating.states[0]) / (guess.root + p.strengths[0])
        out += np.where(known, own[at], 0.0)
    coarse = ask_fine % COARSE
    out *= (p.strengths[1] + p.discounts[1] * guess.coarse_tables[coarse]) / (guess.coarse[coarse] + p.strengths[1])
    if len(seating.pairs):
        pair = at * COARSE + coarse
        i = np.searchsorted(seating.pairs, pair)
        i[i == len(seating.pairs)] = 0
        here = known & (seating.pairs[i] == pair)
        own = seating.middle - p.discounts[1] * seating.states[1]
        out += np.where(here, own[i], 0.0) / (guess.coarse[coarse] + p.strengths[1])
    out *= (p.strengths[2] + p.discounts[2] * guess.fine_tables[ask_fine]) / (guess.fine[ask_fine] + p.strengths[2])
    if len(seating.word):
        rows = seating.of * FINE + seating.fine
        row = at * FINE + ask_fine
        i = np.searchsorted(rows, row)
        i[i == len(rows)] = 0
        here = known & (rows[i] == row)
        own = seating.count - p.discounts[2] * seating.states[2]
        out += np.where(here, own[i], 0.0) / (guess.fine[ask_fine] + p.strengths[2])
    return out


def _pack(values: np.ndarray) -> bytes:
    """First all first bytes, then all second ones and so on, as bytes of one place are alike; compressed."""
    if not len(values):
        return b""
    places = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.compress(pa.py_buffer(places), codec="zstd", asbytes=True)


def _unpack(data: bytes, kind: str, n: int) -> np.ndarray:
    kind = np.dtype(kind)
    if not n:
        return np.zeros(0, kind)
    places = np.frombuffer(pa.decompress(data, n * kind.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(places.reshape(kind.itemsize, n).T).reshape(-1).view(kind)


def _training(batches):
    """Runs of texts of a bounded number of tokens: list of (first row, tokens, contexts, tokens before each text, training texts, ids)."""
    held, size = [], 0
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        train = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for a, token, context, total in tokens(batch.column(2)):
            held.append((row + a, token, context, total, train[a : a + len(total) - 1], batch.column(0).slice(a, len(total) - 1)))
            size += len(token)
            if size >= TOKENS_AT_ONCE:
                yield held
                held, size = [], 0
        row += len(batch)
    if held:
        yield held


def _total_batches(batches):
    """Number of training tokens, in a row without a context; and how often the most frequent contexts of the task occur."""
    n, context, times = 0, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for run in _training(batches):
        n += sum(int(np.diff(total)[train].sum()) for *_, total, train, _ in run)
        more, of = np.unique(np.concatenate([r[2] for r in run]), return_counts=True)
        found, place = np.unique(np.concatenate((context, more)), return_inverse=True)
        times = np.bincount(place, np.concatenate((times, of)), len(found)).astype(np.int64)
        keep = np.sort(np.lexsort((found, -times))[: 4 * IN_BOOK])
        context, times = found[keep], times[keep]
    keep = np.lexsort((context, -times))[:IN_BOOK]
    context, times = context[keep], times[keep]
    columns = [pa.array([n, *[None] * len(keep)], pa.int64()), pa.array([None, *context.view(np.int64).tolist()], pa.int64()), pa.array([None, *times.tolist()], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["n", "context", "times"])


class Book:
    """Codes of words that are frequent as contexts, from 1 on; any book gives the same words back."""

    def __init__(self, often: list[int]):
        """The most frequent first: their codes have a byte that is mostly 0."""
        self.context = np.array([0, *often], np.uint64)
        order = 1 + np.argsort(self.context[1:])
        self.sorted, self.code = self.context[order], order.astype("<u2")

    def pack(self, context: np.ndarray) -> bytes:
        at, here = _places(self.sorted, context)
        code = np.zeros(len(context), "<u2")
        code[here] = self.code[at[here]]
        known = _pack(code)
        return len(known).to_bytes(4, "little") + known + _pack(context[~here].astype("<u8"))

    def unpack(self, data: bytes, n: int) -> np.ndarray:
        end = 4 + int.from_bytes(data[:4], "little")
        code = _unpack(data[4:end], "<u2", n)
        context = self.context[code]
        other = code == 0
        context[other] = _unpack(data[end:], "<u8", int(other.sum()))
        return context


_NO_BOOK = Book([])


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """A part is a range of hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _cuts(part: np.ndarray):
    """(part, first, end) of ascending parts."""
    at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
    return zip(part[at].tolist(), at.tolist(), np.append(at[1:], len(part))[: len(at)].tolist(), strict=True)


def _pack_steps(ascending: np.ndarray) -> bytes:
    return _pack(np.diff(ascending, prepend=np.uint64(0)).astype("<u8"))


def _unpack_steps(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(data, "<u8", n), dtype=np.uint64)


def _counted(word: np.ndarray, context: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, context) in ascending order with the sum of their times."""
    order = np.lexsort((context, word))
    word, context, times = word[order], context[order], times[order]
    new = np.append(True, (word[1:] != word[:-1]) | (context[1:] != context[:-1])) if len(word) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return word[at], context[at], np.add.reduceat(times, at) if len(at) else times


_TYPES = "n int, words binary, contexts binary, counts binary"


def _pack_types(word, context, count, book: Book = _NO_BOOK) -> tuple[int, bytes, bytes, bytes]:
    return len(word), _pack_steps(word), book.pack(context), _pack(count.astype("<u8"))


def _unpack_types(row: dict, book: Book = _NO_BOOK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = row["n"]
    return _unpack_steps(row["words"], n), book.unpack(row["contexts"], n), _unpack(row["counts"], "<u8", n).astype(np.int64)


def _count_batches(batches, parts: int, book: Book):
    """Training counts of (word, context), added up for many texts and packed for the task of each word.

    Those of texts that are held out are there too, with a count of 0.
    """
    for run in _training(batches):
        times = np.concatenate([np.repeat(train, np.diff(total)) for *_, total, train, _ in run]).astype(np.int64)
        word, context, times = _counted(np.concatenate([r[1] for r in run]), np.concatenate([r[2] for r in run]), times)
        cuts = _cuts(_part(word, parts))
        rows = [(part, *_pack_types(word[a:b], context[a:b], times[a:b], book)) for part, a, b in cuts]
        if rows:
            yield _batch(rows, f"part int, {_TYPES}")


_KINDS = {"array<binary>": pa.list_(pa.binary()), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    arrays = [pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def _by_part(batches):
    """Rows of one part after another, from rows sorted by part."""
    now, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] != now and rows:
                yield rows
                rows = []
            now = r["part"]
            rows.append(r)
    if rows:
        yield rows


#: Rows without a context have the types of a part; the others what a part counts of a context: customers and distinct
#: words, and if any of them has more than one customer, as only then the seating depends on the context's other words.
_MERGED = f"part int, context long, fine int, customers long, dishes long, open boolean, {_TYPES}"


def _merge_batches(batches, book: Book):
    """The types of each part, and how often its contexts occur in it."""
    for rows in _by_part(batches):
        part, sent = rows[0]["part"], [_unpack_types(r, book) for r in rows]
        rows.clear()
        word, context, count = _counted(*(np.concatenate(c) for c in zip(*sent, strict=True)))
        yield _batch([(part, *[None] * 5, *_pack_types(word, context, count, book))], _MERGED)
        found, place = np.unique(context, return_inverse=True)
        customers = np.bincount(place, count, len(found)).astype(np.int64)
        dishes = np.bincount(place[count > 0], minlength=len(found))
        opens = np.bincount(place[count > 1], minlength=len(found)) > 0
        columns = [np.full(len(found), part, np.int32), found.view(np.int64), classes(found).astype(np.int32), customers, dishes, opens]
        for a in range(0, len(found), _ROWS):
            mine = [pa.array(c[a : a + _ROWS]) for c in columns]
            n = len(mine[0])
            yield pa.RecordBatch.from_arrays([*mine, pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 3], _names(_MERGED))


_ROWS = 1 << 16
_GIVEN = f"part int, kind int, context long, tables long, {_TYPES}"
_STATES = f"kind string, place long, n long, value double, state array<binary>, {_TYPES.replace('n int', 'types int')}"


def _given_parts(batches):
    """(contexts that ask, their guessed tables, row of types) of one part after another, from rows sorted by part and kind."""
    context, tables = [], []
    for batch in batches:
        kind = batch.column(1).to_numpy()
        at = 0
        for place in [*np.flatnonzero(kind == 1).tolist(), len(kind)]:
            context.append(batch.column(2).slice(at, place - at).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            tables.append(batch.column(3).slice(at, place - at).to_numpy(zero_copy_only=False).astype(np.int64))
            if place < len(kind):
                yield np.concatenate(context), np.concatenate(tables), batch.slice(place, 1).to_pylist()[0]
                context, tables = [], []
            at = place + 1


def _seat_batches(batches, process: Process, guess: Guess, hot: np.ndarray, book: Book):
    """For each part its types with the states of every sample, and the totals of classes and of `hot` contexts."""
    for contexts, tables, row in _given_parts(batches):
        word, context, count = _unpack_types(row, book)
        order = np.argsort(contexts)
        at, here = _places(contexts[order], context)
        rough = np.zeros(len(context))
        rough[here] = tables[order][at[here]]
        learned = count > 0
        seating = Contexts(word[learned], context[learned], count[learned], rough[learned], process, guess)
        place, here = _places(hot, seating.context)
        sums, states, often = [], [], []
        for _ in seating.sampled():
            sums.append(seating.totals())
            states += seating.state()
            often.append(np.bincount(place[here], seating.tables[here], len(hot)))
        none = [None] * 5
        out = [("known", 0, len(seating.above.words), 0.0, *none)]
        out += [("total", i, 0, float(v), *none) for i, v in enumerate(np.concatenate(sums)) if v]
        out += [("hot", i, 0, float(v), *none) for i, v in enumerate(np.concatenate(often)) if v]
        out.append(("state", row["part"], 0, 0.0, states, row["n"], row["words"], row["contexts"], row["counts"]))
        yield _batch(out, _STATES)


def _places(hot: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each context in the ascending list of hot ones, and whether it is there."""
    if not len(hot):
        return np.zeros(len(context), np.int64), np.zeros(len(context), bool)
    at = np.searchsorted(hot, context)
    at[at == len(hot)] = 0
    return at, hot[at] == context


@dataclass
class Hot:
    """Contexts of a large share of the tokens, ascending, and over all words their customers and tables of every sample."""

    context: np.ndarray
    customers: np.ndarray
    tables: np.ndarray


#: Rows of `kind` 0 have types of a part with what is known of them, those of kind 1 the tokens of a run that need them,
#: and those of kind 2 the texts of a run. A run is named by its first row, and its texts are counted from there.
_SENT = (
    "kind int, part long, run long, n int, n_pairs int, words binary, contexts binary, counts binary, uses binary, tables binary, "
    "parents binary, times binary, text binary, known binary, counted binary, score binary, ids binary, tokens binary"
)
#: What was found for texts of a run, packed: places, known tokens, sums; the texts of a run also have ids, folds and tokens.
_FOUND = "run long, n int, text binary, known binary, counted binary, score binary, ids binary, tokens binary"
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, log_count double, score double"


def _score_parts(pair: np.ndarray, context: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    """Types and tokens of a context meet in one part, those of a hot context in a part for each word."""
    return _part(np.where(_places(hot, context)[1], pair, context), parts)


def _type_batches(batches, process: Process, guess: Guess, guesses: list[Guess], hot: np.ndarray, parts: int, book: Book = _NO_BOOK):
    """The types with their tables and the probabilities of their parents, packed for the tasks of the contexts."""
    for batch in batches:
        for at in range(len(batch)):
            row = batch.slice(at, 1).to_pylist()[0]
            word, context, count = _unpack_types({**row, "n": row["types"]}, book)
            learned = count > 0
            seating = Contexts(word[learned], context[learned], count[learned], np.zeros(int(learned.sum())), process, guess)
            a = seating.above
            each = len(row["state"]) // len(guesses)
            asked, place = np.unique(word | classes(context).astype(np.uint64), return_inverse=True)
            tables, parents = np.zeros((len(guesses), len(word)), np.int64), np.zeros((len(guesses), len(word)))
            for i, after in enumerate(guesses):
                seating.restore(row["state"][i * each : (i + 1) * each])
                tables[i, learned] = seating.tables
                parents[i] = probabilities(a, after, asked & ~_CLASS, (asked & _CLASS).astype(np.int64))[place]
            of = np.cumsum(np.append(True, word[1:] != word[:-1])) - 1
            uses = np.bincount(of, count)[of].astype(np.int64)
            part = _score_parts(pairs(word, context), context, hot, parts)
            order = np.argsort(part, kind="stable")  # in a part words ascend, so what belongs to a word is repeated
            for p, x, y in _cuts(part[order]):
                at = order[x:y]
                packed = [_pack_steps(word[at]), book.pack(context[at]), *(_pack(c.astype("<u8")) for c in (count[at], uses[at], tables[:, at].ravel()))]
                yield _batch([(0, p, None, y - x, None, *packed, _pack(parents[:, at].ravel().astype("<f4")), *[None] * 7)], _SENT)


def _send_batches(batches, hot: np.ndarray, parts: int, book: Book):
    """The texts of each run, and their tokens packed for the tasks of their contexts."""
    for run in _training(batches):
        base = run[0][0]
        ids, sizes, trains, text = [], [], [], []
        for row, _, _, total, train, doc_ids in run:
            text.append(np.repeat(row - base + np.arange(len(total) - 1), np.diff(total)))
            sizes.append((row - base + np.arange(len(total) - 1), np.diff(total) * 2 + ~train))
            ids.append(doc_ids)
        places, tokens_ = (np.concatenate(c) for c in zip(*sizes, strict=True))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as writer:
            for x in ids:
                writer.write_batch(pa.RecordBatch.from_arrays([x], ["doc_id"]))
        nothing = np.zeros(len(places))
        whole = _found(base, places, nothing, nothing, nothing, sink.getvalue().to_pybytes(), tokens_.astype("<i8").tobytes())
        word, context, text = np.concatenate([r[1] for r in run]), np.concatenate([r[2] for r in run]), np.concatenate(text)
        part = _score_parts(pairs(word, context), context, hot, parts)
        order = np.lexsort((word, context, part))
        word, context, text = word[order], context[order], text[order]
        out = [(2, base % parts, base, whole[1], *[None] * 8, *whole[2:])]
        for p, a, b in _cuts(part[order]):
            new = (word[a + 1 : b] != word[a : b - 1]) | (context[a + 1 : b] != context[a : b - 1])
            at = np.flatnonzero(np.append(True, new))
            times = np.diff(np.append(at, b - a)).astype("<u4")
            types = book.pack(word[a:b][at]), _pack_steps(context[a:b][at])  # a context stands once, all its words are here
            out.append((1, p, base, b - a, len(at), *types, *[None] * 4, _pack(times), _pack(text[a:b].astype("<u4")), *[None] * 5))
        yield _batch(out, _SENT)


def _known_types(rows: list[dict], process: Process, hot: Hot, samples: int, book: Book = _NO_BOOK) -> tuple[np.ndarray, ...]:
    """The types of a part, ascending: pair, training count of the word, log10 of the probability."""
    word, context, count = (np.concatenate(c) for c in zip(*(_unpack_types(r, book) for r in rows), strict=True))
    uses = np.concatenate([_unpack(r["uses"], "<u8", r["n"]) for r in rows])
    tables = np.concatenate([_unpack(r["tables"], "<u8", r["n"] * samples).reshape(samples, -1) for r in rows], 1).astype(np.float64)
    parents = np.concatenate([_unpack(r["parents"], "<f4", r["n"] * samples).reshape(samples, -1) for r in rows], 1).astype(np.float64)
    pair = pairs(word, context)
    found, of = np.unique(context, return_inverse=True)
    place, here = _places(hot.context, found)
    count = count.astype(np.float64)
    customers = np.bincount(of, count, len(found))
    customers[here] = hot.customers[place[here]]
    d, s = process.discounts[3], process.strengths[3]
    mean = np.zeros(len(pair))
    for mine, parent, often in zip(tables, parents, hot.tables, strict=True):
        all_tables = np.bincount(of, mine, len(found))
        all_tables[here] = often[place[here]]
        mean += (count - d * mine + (s + d * all_tables[of]) * parent) / (customers[of] + s)
    order = np.argsort(pair)
    return pair[order], uses[order].astype(np.int64), np.log10(mean[order] / samples)


def _score_batches(batches, process: Process, hot: Hot, samples: int, book: Book):
    """What the tokens of each part add to their texts, from rows sorted by part and kind; tokens pass one run at a time."""
    now, rows, known = None, [], None
    for batch in batches:
        for i in range(len(batch)):
            r = batch.slice(i, 1).to_pylist()[0]
            if r["part"] != now:
                now, rows, known = r["part"], [], None
            if r["kind"] == 0:
                rows.append(r)
            elif r["kind"] == 2:
                yield _batch([tuple(r[name] for name in _names(_FOUND))], _FOUND)
            else:
                if known is None:
                    known, rows = _known_types(rows, process, hot, samples, book), []
                pair, uses, log10 = known
                asked = pairs(book.unpack(r["words"], r["n_pairs"]), _unpack_steps(r["contexts"], r["n_pairs"]))
                at = np.searchsorted(pair, asked)
                times, of = _unpack(r["times"], "<u4", r["n_pairs"]), _unpack(r["text"], "<u4", r["n"]).astype(np.int64)
                text = np.flatnonzero(np.bincount(of))
                values = (uses[at] > 0, np.log10(uses[at] + 1.0), log10[at])
                yield _batch([_found(r["run"], text, *(np.bincount(of, np.repeat(v, times))[text] for v in values))], _FOUND)


def _found(run: int, text, known, counted, score, ids=b"", tokens_=b"") -> tuple:
    return (run, len(text), _pack(text.astype("<u4")), _pack(known.astype("<u4")), _pack(counted), _pack(score), ids, tokens_)


def _sum_batches(batches):
    """The texts of each run with all that was found for them, from rows sorted by run."""
    now, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["run"] != now and rows:
                yield _summed(rows)
                rows = []
            now = r["run"]
            rows.append(r)
    if rows:
        yield _summed(rows)


def _summed(rows: list[dict]) -> pa.RecordBatch:
    whole = next(r for r in rows if r["tokens"])
    n = whole["n"]
    known, counted, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
    # The same order in every attempt, as sums of doubles depend on it.
    for r in sorted(rows, key=lambda r: (r["n"], r["text"], r["score"])):
        text = _unpack(r["text"], "<u4", r["n"])
        known[text] += _unpack(r["known"], "<u4", r["n"])
        counted[text] += _unpack(r["counted"], "<f8", r["n"])
        score[text] += _unpack(r["score"], "<f8", r["n"])
    tokens_ = np.frombuffer(whole["tokens"], "<i8")
    ids = pa.ipc.open_stream(whole["ids"]).read_all().combine_chunks().column(0).chunk(0)
    columns = [ids, pa.array(tokens_ % 2 == 1), pa.array(tokens_ // 2), pa.array(known), pa.array(counted), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])


def score_texts(docs: DataFrame, process: Process = Process(), id_column="doc_id", text_column="text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all rows that are not held out. `base_score` is the sum of log10((c + 1) / (N + V + 1)), `score` the
    sum of the log10 of the predictive probabilities averaged over the samples. Counts are exact up to collisions
    of 56-bit hashes of words and 64-bit hashes of pairs. The seating of a word's restaurants is drawn by Gibbs sweeps with
    rough totals (the customers and distinct words of each context); the scores use the sums of the sampled tables.

    Three passes read the texts: one counts the tokens and finds frequent contexts, which travel as short codes, one counts the
    words after each context, one scores. Counts are added up
    before they are sent, and meet in the task of their word to be seated. Tables and tokens meet in the task of their
    context; those of a context with at least 1 / `frequent` of the training tokens are dealt over many tasks.

    A null or empty text is its end token alone; a null id counts as the text "" when rows are held out; repeated rows
    count and are scored each; an empty table gives no rows; other columns are ignored. Without training rows every
    token has the probability of an unknown one.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), held_out(id_column, process).alias("held_out"), F.col(text_column).cast("string").alias("text")
    )
    often = written(rows.mapInArrow(_total_batches, "n long, context long, times long"), "pitman-yor-often")
    total = often.agg(F.sum("n")).first()[0] or 0
    often = often.filter("context is not null").groupBy("context").agg(F.sum("times").alias("times"))
    often = often.orderBy(F.desc("times"), "context").limit(IN_BOOK).collect()  # a bounded list
    book = Book([r["context"] % (1 << 64) for r in often])
    parts = max(1, -(-total // TOKENS_IN_TASK))
    counts = rows.mapInArrow(partial(_count_batches, parts=parts, book=book), f"part int, {_TYPES}").repartition(parts, "part").sortWithinPartitions("part")
    merged = written(counts.mapInArrow(partial(_merge_batches, book=book), _MERGED), "pitman-yor-types")
    types, asked = merged.filter("context is null"), merged.filter("context is not null")
    contexts = asked.groupBy("context", "fine").agg(F.sum("customers").alias("customers"), F.sum("dishes").alias("tables"))
    contexts = written(contexts, "pitman-yor-contexts")
    fine = np.zeros(FINE)
    for r in contexts.groupBy("fine").agg(F.sum("tables").alias("n")).collect():  # a row per class
        fine[r["fine"]] = r["n"]
    guess = Guess.before(fine)
    often = contexts.filter(F.col("customers") >= max(1, -(-total // frequent))).collect()  # `frequent` rows at most
    often = sorted((r["context"] % (1 << 64), r["customers"]) for r in often)
    hot = np.array([c for c, _ in often], np.uint64)

    given = asked.filter("open").join(contexts.select("context", "tables"), "context").select("part", F.lit(0).alias("kind"), "context", "tables")
    given = given.unionByName(types.select("part", F.lit(1).alias("kind"), *_names(_TYPES)), allowMissingColumns=True)
    given = given.select(*_names(_GIVEN)).repartition(parts, "part").sortWithinPartitions("part", "kind")
    states = written(given.mapInArrow(partial(_seat_batches, process=process, guess=guess, hot=hot, book=book), _STATES), "pitman-yor-states")
    # Nothing reads these any more; without a name Spark clears their shuffles, too.
    drop_written(merged)
    drop_written(contexts)
    del counts, merged, types, asked, contexts, given
    known = states.filter("kind = 'known'").agg(F.sum("n")).first()[0] or 0

    def sums(kind: str, size: int) -> np.ndarray:
        """Totals of every sample, `size` numbers each."""
        out = np.zeros(process.samples * size)
        for r in states.filter(F.col("kind") == kind).groupBy("place").agg(F.sum("value").alias("v")).collect():
            out[r["place"]] = r["v"]
        return out.reshape(process.samples, size)

    guesses = [Guess.after(s[:FINE], s[FINE:], known) for s in sums("total", 2 * FINE + 2 * COARSE + 2)]
    heavy = Hot(hot, np.array([n for _, n in often], np.float64), sums("hot", len(hot)))
    types = partial(_type_batches, process=process, guess=guess, guesses=guesses, hot=hot, parts=parts, book=book)
    sent = states.filter("kind = 'state'").mapInArrow(types, _SENT)
    sent = sent.unionByName(rows.mapInArrow(partial(_send_batches, hot=hot, parts=parts, book=book), _SENT))
    sent = sent.repartition(parts, "part").sortWithinPartitions("part", "kind")
    scored = sent.mapInArrow(partial(_score_batches, process=process, hot=heavy, samples=process.samples, book=book), _FOUND)
    out = scored.repartition("run").sortWithinPartitions("run").mapInArrow(_sum_batches, _SCORED)
    unit = float(np.log10(total + known + 1.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_count") - F.col("n_tokens") * unit).alias("base_score"), "score",
    )
