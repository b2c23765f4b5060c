"""Toxicity by a factorization machine over hashed terms, which learns pairs of terms besides single ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import words
from tidymart.session import written

SAMPLE_ROWS = 20_000
TERMS = 2_048
#: Score of every text where the labels do not hold both kinds: nothing is learned, so nothing is toxic.
NOTHING_LEARNED = 0.01
#: Lengths in bytes of the word beginnings that are terms besides whole words.
PREFIXES = (4, 5, 7)
_BUCKET_BITS = np.uint64(44)  # 2**20 buckets


@dataclass
class Model:
    """Terms in ascending order, their weights and factors, and the bias."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def text_terms(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms (words and word beginnings) and the text each stands in, repeats included."""
    begin, end, first = words.word_spans(data, starts, words.PUNCTUATION)
    lower = words.lowered(data)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(first))
    found, where = [words.hash_spans(lower, begin, end)], [text]
    for n in PREFIXES:
        longer = end - begin > n
        head = words.hash_spans(lower, begin[longer], begin[longer] + n)
        found.append(words.mix(head + np.uint64(n)))
        where.append(text[longer])
    return np.concatenate(found), np.concatenate(where)


class Lookup:
    """Place of a term in an ascending list, -1 if it is not there; a table of buckets answers most at once."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.taken = np.zeros(1 << 20, bool)
        self.taken[terms >> _BUCKET_BITS] = True

    def find(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `terms` that are listed, and their places in the list."""
        at = np.flatnonzero(self.taken[terms >> _BUCKET_BITS])
        place = np.searchsorted(self.terms, terms[at])
        place[place == len(self.terms)] = 0
        same = self.terms[place] == terms[at] if len(self.terms) else np.zeros(len(at), bool)
        return at[same], place[same]


def _count_batches(batches):
    """Toxic and clean texts that have a term: one row per term and batch."""
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        pairs = []
        for a, _, data, starts in words.chunks(batch.column(2)):
            terms, text = text_terms(data, starts)
            order = np.lexsort((text, terms))
            terms, text = terms[order], text[order] + a
            new = np.ones(len(terms), bool)
            new[1:] = (terms[1:] != terms[:-1]) | (text[1:] != text[:-1])
            pairs.append((terms[new], toxic[text[new]]))
        if not pairs:
            continue
        terms, marks = (np.concatenate(x) for x in zip(*pairs, strict=True))
        terms, inverse = np.unique(terms, return_inverse=True)
        bad = np.bincount(inverse, marks, len(terms)).astype(np.int64)
        all_ = np.bincount(inverse, minlength=len(terms))
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms.view(np.int64)), pa.array(bad), pa.array(all_ - bad)], ["term", "toxic", "clean"]
        )


def _present_batches(batches, terms: np.ndarray):
    """Places of the chosen terms in each text."""
    lookup = Lookup(terms)
    for batch in batches:
        lists = []
        for a, b, data, starts in words.chunks(batch.column(2)):
            found, text = text_terms(data, starts)
            at, place = lookup.find(found)
            pairs = np.unique(text[at] * len(terms) + place)
            cut = np.searchsorted(pairs, np.arange(b - a + 1) * len(terms))
            lists += [(pairs[cut[k] : cut[k + 1]] % len(terms)).astype(np.int32) for k in range(b - a)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "toxic", "places"])


def raw_scores(places: np.ndarray, text: np.ndarray, rows: int, model: Model) -> np.ndarray:
    """Bias, weights and pair interactions of the terms that are present, for each of `rows` texts."""
    places = places.astype(np.int64)  # an empty list has no type
    linear = np.bincount(text, model.weights[places], rows)
    pairs = np.zeros(rows)
    for v in model.factors.T:
        x = v[places]
        pairs += np.bincount(text, x, rows) ** 2 - np.bincount(text, x * x, rows)
    return model.bias + linear + 0.5 * pairs


def fit(lists: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, factors=4, epochs=20, batch=256, rate=0.05, decay=1e-4, seed=7) -> Model:
    """Fit by mini-batches with adaptive steps on the logistic loss; the seed fixes the order and first factors."""
    random = np.random.default_rng(seed)
    n = len(terms)
    share = min(max(float(labels.mean()) if len(labels) else 0.5, 0.01), 0.99)
    model = Model(terms, float(np.log(share / (1 - share))), np.zeros(n), random.normal(0, 0.01, (n, factors)))
    squares_w, squares_v, squares_b = np.full(n, 1e-6), np.full((n, factors), 1e-6), 1e-6
    for _ in range(epochs if n else 0):
        order = random.permutation(len(lists))
        for k in range(0, len(order), batch):
            rows = order[k : k + batch]
            sizes = np.array([len(lists[r]) for r in rows])
            places = np.concatenate([lists[r] for r in rows]).astype(np.int64)
            text = np.repeat(np.arange(len(rows)), sizes)
            raw = np.clip(raw_scores(places, text, len(rows), model), -30, 30)
            error = (1 / (1 + np.exp(-raw)) - labels[rows]) / len(rows)
            squares_b += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(squares_b)
            if not len(places):
                continue
            used, inverse = np.unique(places, return_inverse=True)
            g = np.bincount(inverse, error[text], len(used)) + decay * model.weights[used]
            squares_w[used] += g * g
            model.weights[used] -= rate * g / np.sqrt(squares_w[used])
            v = model.factors[places]
            sums = np.stack([np.bincount(text, c, len(rows)) for c in v.T], 1)
            slope = error[text][:, None] * (sums[text] - v)
            g = np.stack([np.bincount(inverse, c, len(used)) for c in slope.T], 1) + decay * model.factors[used]
            squares_v[used] += g * g
            model.factors[used] -= rate * g / np.sqrt(squares_v[used])
    return model


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, most_terms: int = TERMS, id_column="doc_id", text_column="text", label_column="toxic") -> Model:
    """Fit on a bounded sample of labelled documents: the `sample_rows` with the smallest hash of their id.

    The terms are the `most_terms` that stand out most in toxic texts of the sample: at least three toxic texts hold them,
    and their share there is 1.5 standard errors above the one in clean texts. Pairs are learned among these. Ids and labels of the
    sample are small by this bound and are broadcast to the documents; their texts are written once. Rows without a label
    or id are not learned from; of several labels of an id the highest counts, and rows that repeat an id are each learned from.
    Where the labels are of one kind or there are none, the model has no terms and every text scores `NOTHING_LEARNED`. Columns
    besides the named ones are ignored.
    """
    wanted = labels.select(F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("__toxic"))
    wanted = wanted.dropna().groupBy("__id").agg(F.max("__toxic").alias("__toxic"))
    wanted = wanted.orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    rows = docs.join(F.broadcast(wanted), docs[id_column] == wanted["__id"])
    rows = rows.select(F.col("__id").cast("long").alias("doc_id"), (F.col("__toxic") > 0).cast("int").alias("toxic"), F.col(text_column).alias("text"))
    sample = written(rows, "toxicity-sample")
    totals = sample.agg(F.sum("toxic"), F.count("*")).first()
    bad, all_ = int(totals[0] or 0), int(totals[1])
    if not bad or bad == all_:
        return Model(np.zeros(0, np.uint64), float(np.log(NOTHING_LEARNED / (1 - NOTHING_LEARNED))), np.zeros(0), np.zeros((0, 1)))
    counts = sample.mapInArrow(_count_batches, "term long, toxic long, clean long")
    counted = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    in_toxic, in_clean = F.col("toxic") / bad, F.col("clean") / (all_ - bad)
    spread = (F.col("toxic") + F.col("clean") + 1) / all_
    clear = (in_toxic - in_clean) / F.sqrt(spread * (1 / bad + 1 / (all_ - bad)))
    best = counted.filter("toxic >= 3").select("term", clear.alias("z")).filter("z > 1.5").orderBy(F.desc("z"), "term").limit(most_terms)
    terms = np.sort(np.array([r["term"] for r in best.collect()], np.int64).view(np.uint64))
    lists = sample.mapInArrow(partial(_present_batches, terms=terms), "doc_id long, toxic int, places array<int>")
    found = lists.toPandas().sort_values("doc_id", kind="stable")  # bounded by the sample
    return fit([np.asarray(p, np.int64) for p in found["places"]], found["toxic"].to_numpy(float), terms)


def _score_batches(batches, model: Model):
    lookup = Lookup(model.terms)
    for batch in batches:
        scores = []
        for a, b, data, starts in words.chunks(batch.column(1)):
            found, text = text_terms(data, starts)
            at, place = lookup.find(found)
            pairs = np.unique(text[at] * max(1, len(model.terms)) + place)
            text, place = np.divmod(pairs, max(1, len(model.terms)))
            raw = raw_scores(place, text, b - a, model)
            scores.append(1 / (1 + np.exp(-np.clip(raw, -30, 30))))
        found = np.concatenate(scores) if scores else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "score"])


def score(docs: DataFrame, model: Model, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc_id, score) of every row; the score depends on the text alone. A null text counts as empty and has the
    score of a text without listed terms; repeated rows are scored alike; an empty table gives no rows."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(partial(_score_batches, model=model), "doc_id long, score double")


def held_out(id_column: str = "doc_id", folds: int = 5):
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents whose score stays below `limit`, with all their columns; labels of held-out rows are not used.

    Without labels of both kinds nothing is dropped. A null text is scored as an empty one; repeated rows stay or go together,
    null ids too; an empty table gives no rows.
    """
    model = train(docs, labels.filter(~held_out()))
    scored = partial(_keep_batches, model=model, limit=limit, at=docs.columns.index("text"))
    return docs.mapInArrow(scored, docs.schema)


def _keep_batches(batches, model: Model, limit: float, at: int):
    for batch in batches:
        rows = pa.RecordBatch.from_arrays([pa.nulls(len(batch), pa.int64()), batch.column(at)], ["doc_id", "text"])
        scores = next(_score_batches(iter([rows]), model)).column(1).to_numpy()
        yield batch.filter(pa.array(scores < limit))
