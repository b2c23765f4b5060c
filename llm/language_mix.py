"""Languages of a text as a mixture: expectation-maximisation over word likelihoods, set chosen by penalised likelihood.

Every language has a distribution over hashed letter runs (n-grams), counted over all its training texts. The
likelihood of a word under a language is the product over its n-grams. A text is a mixture of languages: EM estimates
its proportions over all languages. A set of languages must pay for each member (half the logarithm of the number of
words, times a weight), so a few chance words do not add a language. The prediction is the member with the largest
proportion.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import words

#: Letters in an n-gram; a blank stands before and after each word.
ORDER = 3
#: Hashed n-grams.
BINS = 1 << 16
#: Languages that a model tells apart, the most frequent ones; with BINS it bounds what every task gets (4 bytes a cell).
MOST_LANGUAGES = 128
#: Letters after which a run without a break begins a new unit of the mixture.
UNIT_LETTERS = 16
CHUNK_BYTES = 1 << 18
ROUNDS = 40
UNKNOWN = "und"


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: is it a letter, is it part of a word (marks are), and its lower case."""
    points = range(0x110000)
    kinds = [unicodedata.category(chr(p))[0] for p in points]
    letter = np.array([k == "L" for k in kinds])
    lower = np.fromiter((ord(c) if len(c := chr(p).lower()) == 1 else p for p in points), np.uint32, 0x110000)
    return letter, letter | np.array([k == "M" for k in kinds]), lower


@dataclass
class Grams:
    """Bins of all n-grams, the unit each lies in, the text of each unit, and which texts have a letter."""

    bins: np.ndarray
    unit: np.ndarray
    text: np.ndarray
    lettered: np.ndarray


def grams_of(data: np.ndarray, starts: np.ndarray) -> Grams:
    """The n-grams of a run of texts, from their UTF-8 bytes and the place where each begins."""
    letter, inside, lower = _tables()
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # code points before each byte
    first = heads[starts]
    part = inside[points]
    opens = part.copy()
    opens[1:] &= ~part[:-1]
    cut = first[:-1][first[:-1] < len(points)]
    opens[cut] = part[cut]
    begin = np.flatnonzero(opens)
    word = np.cumsum(opens) - 1  # of the code points inside
    at = np.flatnonzero(part)
    word = word[at]
    place = at - begin[word] if len(at) else at
    length = np.bincount(word, minlength=len(begin))
    # Each word with a blank on both sides, one after the other.
    slot = np.concatenate(([0], np.cumsum(length + 2)))
    padded = np.full(slot[-1], 0x20, np.uint64)
    padded[slot[word] + 1 + place] = lower[points[at]]
    grams = np.maximum(length + 3 - ORDER, 1)
    of = np.repeat(np.arange(len(begin)), grams)
    offset = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams)
    spot = slot[of] + offset
    value = np.zeros(len(spot), np.uint64)
    for k in range(ORDER):
        value = value * np.uint64(0x110000 + 1) + padded[np.minimum(spot + k, max(len(padded) - 1, 0))]
    bins = (words.mix(value) >> np.uint64(40)).astype(np.int64) % BINS
    new = (offset % UNIT_LETTERS) == 0
    text_of_word = np.searchsorted(first, begin, "right") - 1
    seen = np.concatenate(([0], np.cumsum(letter[points])))
    return Grams(bins, np.cumsum(new) - 1, text_of_word[of[new]], seen[first[1:]] > seen[first[:-1]])


def _count_batches(batches, languages: list[str]):
    """(lang, bin, n) of a task: one table of counts for each language, so memory does not follow the texts."""
    place = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((len(languages), BINS), np.int64)
    for batch in batches:
        own = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
        for a, _, data, starts in words.chunks(batch.column(1), CHUNK_BYTES):
            grams = grams_of(data, starts)
            cell = own[a + grams.text[grams.unit]] * BINS + grams.bins
            counts += np.bincount(cell, minlength=counts.size).reshape(counts.shape)
    lang, bins = np.nonzero(counts)
    names = pa.array(languages, pa.string()).take(pa.array(lang)) if len(lang) else pa.array([], pa.string())
    yield pa.RecordBatch.from_arrays([names, pa.array(bins), pa.array(counts[lang, bins])], ["lang", "bin", "n"])


@dataclass
class Model:
    """Languages in alphabetical order, and the logarithm of each bin's probability under each of them."""

    languages: list[str]
    log_probability: np.ndarray  # bins x languages, float32


def fitted(languages: list[str], counts: np.ndarray, weight: float = 0.5) -> Model:
    """Probabilities from counts (languages x bins); `weight` is added to every bin."""
    smooth = counts + weight
    return Model(languages, np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32))


def train(docs: DataFrame, most_languages: int = MOST_LANGUAGES, lang_column="lang", text_column="text") -> Model:
    """Count the n-grams of every document with a language; only the counts, bounded by bins and languages, reach the driver.

    Rows without a language teach nothing, nor do null or empty texts; repeated rows count as often as they come; other columns are
    ignored. Beyond `most_languages` the rarer ones (ties by name) are not learned. Without a language the model is empty.
    """
    rows = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text")).dropna()
    names = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    languages = sorted(r["lang"] for r in names)
    if not languages:
        return Model([], np.zeros((BINS, 0), np.float32))
    counted = rows.filter(F.col("lang").isin(*languages)).mapInArrow(partial(_count_batches, languages=languages), "lang string, bin long, n long")
    summed = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    place = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((len(languages), BINS))
    at = np.array([place[x] for x in summed.column("lang").to_pylist()], np.int64)
    counts[at, summed.column("bin").to_numpy()] = summed.column("n").to_numpy()
    return fitted(languages, counts)


def unit_likelihoods(grams: Grams, model: Model) -> np.ndarray:
    """Log likelihood of each unit under each language."""
    heads = np.flatnonzero(np.diff(grams.unit, prepend=-1))
    if not len(heads):
        return np.zeros((0, len(model.languages)))
    return np.add.reduceat(model.log_probability[grams.bins], heads, axis=0, dtype=np.float64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of runs of rows; no run is empty."""
    return np.add.reduceat(values, bounds[:-1], axis=0)


def mixtures(scaled: np.ndarray, bounds: np.ndarray, allowed: np.ndarray, rounds: int = ROUNDS, tolerance: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihood of each text by EM.

    `scaled` has the likelihood of each unit under each language, divided by the unit's largest; `bounds` where the units of
    each text begin (one more for the end); `allowed` the languages of each text's set. A text leaves when no proportion moves.
    """
    share = allowed / allowed.sum(1, keepdims=True)
    sizes = np.diff(bounds)
    result = share.copy()
    live, units, edges, part = np.arange(len(sizes)), scaled, bounds, share
    for turn in range(rounds):
        weights = units * np.repeat(part, np.diff(edges), axis=0)
        weights /= weights.sum(1, keepdims=True)
        moved = _sums(weights, edges) / np.diff(edges)[:, None]
        result[live] = moved
        still = np.abs(moved - part).max(1) > tolerance
        part = moved
        if not still.any():
            break
        if turn % 4 == 3 and still.mean() < 0.7:
            units = units[np.repeat(still, np.diff(edges))]
            edges = np.concatenate(([0], np.cumsum(np.diff(edges)[still])))
            live, part = live[still], part[still]
    fit = np.log(np.maximum((scaled * np.repeat(result, sizes, axis=0)).sum(1), 1e-300))
    return result, _sums(fit, bounds)


def choose(logs: np.ndarray, bounds: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Chosen sets (text x language) and proportions within them.

    The best single language is the start. EM over all languages bounds what any set can reach: where that gains no more than one
    language costs, the single one stays. Elsewhere languages leave in ascending order of their proportion, each set is
    fitted anew, and the best penalised likelihood wins. Ties go to the smaller set and the first language.
    """
    sizes, n = np.diff(bounds), logs.shape[1]
    peak = logs.max(1, keepdims=True)
    scaled = np.maximum(np.exp(logs - peak), 1e-30)
    single = _sums(logs - peak, bounds)
    best = single.argmax(1)
    chosen = np.zeros((len(sizes), n), bool)
    chosen[np.arange(len(sizes)), best] = True
    share = chosen.astype(float)
    if n == 1:
        return chosen, share
    cost = penalty * 0.5 * np.log(sizes + 1.0)
    part, fit = mixtures(scaled, bounds, np.ones((len(sizes), n)))
    open_ = np.flatnonzero(fit - single.max(1) > cost)
    if not len(open_):
        return chosen, share
    own = np.zeros(len(sizes), bool)
    own[open_] = True
    units = scaled[np.repeat(own, sizes)]
    edges = np.concatenate(([0], np.cumsum(sizes[open_])))
    allowed = np.ones((len(open_), n), bool)
    part, fit = part[open_], fit[open_]
    top = single.max(1)[open_] - cost[open_]
    row = np.arange(len(open_))
    for size in range(n, 1, -1):
        value = fit - size * cost[open_]
        better = value > top
        top = np.where(better, value, top)
        chosen[open_[better]], share[open_[better]] = allowed[better], part[better]
        allowed[row, np.where(allowed, part, np.inf).argmin(1)] = False
        if size > 2:
            part, fit = mixtures(units, edges, allowed)
    return chosen, share


def predict_texts(grams: Grams, model: Model, texts: int, penalty: float) -> tuple[list[str], np.ndarray, list[list[str]]]:
    """Language, its proportion, and the chosen set of each text."""
    names = [UNKNOWN] * texts
    score = np.zeros(texts)
    sets: list[list[str]] = [[] for _ in range(texts)]
    if not model.languages or not len(grams.text):
        return names, score, sets
    own, at = np.unique(grams.text, return_index=True)
    bounds = np.append(at, len(grams.text))
    chosen, share = choose(unit_likelihoods(grams, model), bounds, penalty)
    for text, row, part in zip(own.tolist(), chosen, share, strict=True):
        if grams.lettered[text]:
            top = int(part.argmax())
            names[text], score[text] = model.languages[top], min(1.0, float(part[top]))
            sets[text] = [model.languages[k] for k in np.flatnonzero(row)]
    return names, score, sets


def _predict_batches(batches, model: Model, penalty: float):
    for batch in batches:
        names, scores, sets = [], [], []
        for a, b, data, starts in words.chunks(batch.column(1), CHUNK_BYTES):
            found = predict_texts(grams_of(data, starts), model, b - a, penalty)
            names += found[0]
            scores.append(found[1])
            sets += found[2]
        score = np.concatenate(scores) if scores else np.zeros(0)
        columns = [batch.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(sets, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "languages"])


def predict(docs: DataFrame, model: Model, penalty: float = 4.0, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row: language with the largest proportion, the proportion, the set.

    A text that is null or has no letter is ``und`` with score 0 and an empty set, as is every text under an empty model.
    Whole texts are read, of any length; the result depends on the text alone, so repeated rows are alike; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict_batches, model=model, penalty=penalty), "doc_id long, lang_pred string, score double, languages array<string>")


def held_out(id_column: str = "doc_id", folds: int = 3) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 1
