import numpy as np
import pyarrow as pa
import pytest
from cases import documents
from test_pitman_yor import is_held_out

from llm import pitman_yor
from llm.pitman_yor import FINE, Contexts, Guess, Hot, Process, classes, score_texts, tokens
from tidymart import session


def word(text):
    return next(tokens(pa.array([text])))[1][0]


def of_one_class():
    """Two words whose contexts have the same class."""
    seen = {}
    for i in range(10_000):
        other = seen.setdefault(int(classes(np.array([word(f"w{i}")]))[0]), f"w{i}")
        if other != f"w{i}":
            return other, f"w{i}"


def test_context_is_the_word_before():
    _, token, context, total = next(tokens(pa.array(["One two  one", "", None])))
    assert token.tolist() == [word("one"), word("two"), word("one"), pitman_yor.END, pitman_yor.END, pitman_yor.END]
    assert context.tolist() == [pitman_yor.START, word("one"), word("two"), word("one"), pitman_yor.START, pitman_yor.START]
    assert total.tolist() == [0, 4, 5, 6]


@pytest.mark.parametrize("frequent", [4096, 4])
def test_words_of_one_class_have_their_own_counts(spark, frequent):
    x, y = of_one_class()
    train = [i for i in range(1, 400) if not is_held_out(i)]
    held = [i for i in range(400, 500) if is_held_out(i)][:4]
    rows = [(i, f"{x} salt" if i % 2 else f"{y} pepper") for i in train]
    rows += zip(held, [f"{x} salt", f"{x} pepper", f"{y} pepper", f"{y} salt"], strict=True)
    score = {r["doc_id"]: r["score"] for r in score_texts(documents(spark, rows), frequent=frequent).collect()}
    usual, never, usual_too, never_too = (score[i] for i in held)
    assert usual > never + 1 and usual_too > never_too + 1


def test_a_text_that_occurs_again_is_likelier(spark):
    """A model with few contexts gives a text that was learned and one of the same words in another order much the same."""
    r = np.random.default_rng(2)
    train = [i for i in range(1, 400) if not is_held_out(i)]
    held = [i for i in range(400, 500) if is_held_out(i)][:2]
    rows = [(i, " ".join(f"v{k}" for k in r.integers(0, 2000, 60))) for i in train]
    again = rows[7][1]
    shuffled = " ".join(r.permutation(again.split()))
    score = {x["doc_id"]: x["score"] for x in score_texts(documents(spark, [*rows, (held[0], again), (held[1], shuffled)])).collect()}
    assert score[held[0]] > score[held[1]] + 30


@pytest.mark.parametrize("hot", [0, 3])
def test_probabilities_after_a_context_sum_to_one(hot):
    r = np.random.default_rng(4)
    vocabulary = np.sort(r.integers(1, 1 << 50, 30).astype(np.uint64) << np.uint64(8))
    contexts = np.sort(np.append(vocabulary[:9], pitman_yor.START))
    every = np.array([(w, c) for w in np.append(vocabulary, vocabulary[-1] + np.uint64(256)) for c in contexts], np.uint64)
    count = np.where(r.random(len(every)) < 0.4, r.integers(1, 400, len(every)), 0)
    count[-len(contexts) :] = 0  # the unknown word
    learned = count > 0
    process = Process()
    dishes = np.array([learned[every[:, 1] == c].sum() for c in contexts])
    guess = Guess.before(np.bincount(classes(contexts), dishes, FINE))
    rough = dishes[np.searchsorted(contexts, every[learned, 1])]
    seating = Contexts(every[learned, 0], every[learned, 1], count[learned], rough, process, guess)
    known = len(seating.above.words)
    states, guesses, tables = [], [], []
    frequent = contexts[:hot]
    for _ in seating.sampled():
        assert ((seating.tables >= 1) & (seating.tables <= seating.count)).all()
        totals = seating.totals()
        states += seating.state()
        guesses.append(Guess.after(totals[:FINE], totals[FINE:], known))
        tables.append([seating.tables[seating.context == c].sum() for c in frequent])
    row = pitman_yor._pack_types(every[:, 0], every[:, 1], count)
    stored = pitman_yor._batch([("state", 0, 0, 0.0, states, *row)], pitman_yor._STATES)
    sent = [x for b in pitman_yor._type_batches([stored], process, guess, guesses, frequent, 1) for x in b.to_pylist()]
    customers = np.array([count[every[:, 1] == c].sum() for c in frequent], float)
    heavy = Hot(frequent, customers, np.array(tables, float).reshape(process.samples, hot))
    pair, _, log10 = pitman_yor._known_types(sent, process, heavy, process.samples)
    p = 10 ** log10[np.searchsorted(pair, pitman_yor.pairs(every[:, 0], every[:, 1]))]
    for c in contexts:
        mine = (every[:, 1] == c) & np.isin(every[:, 0], np.append(seating.above.words, vocabulary[-1] + np.uint64(256)))
        assert p[mine].sum() == pytest.approx(1) and (p[mine] > 0).all()


def test_frequent_contexts_travel_as_two_bytes():
    """All contexts come back whatever the book has; most rows of frequent ones cost far less than a hash."""
    r = np.random.default_rng(4)
    hashes = r.integers(1, 1 << 56, 5000).astype(np.uint64) << np.uint64(8)
    context = hashes[np.minimum(r.zipf(1.3, 40_000), 5000) - 1]
    book = pitman_yor.Book(hashes[:1000].tolist())
    for asked in (context, context[:0], hashes[2000:], hashes[:1]):
        assert (book.unpack(book.pack(asked), len(asked)) == asked).all()
        assert (pitman_yor.Book([]).unpack(pitman_yor.Book([]).pack(asked), len(asked)) == asked).all()
    assert len(book.pack(context)) < len(pitman_yor._pack(context.astype("<u8"))) / 1.5


def test_only_what_the_scores_need_stays_in_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    docs = spark.createDataFrame([(i, f"some words {i % 3} and others") for i in range(60)], "doc_id long, text string")
    assert pitman_yor.score_texts(docs).count() == 60
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "tidymart").iterdir()}
    assert left == {"pitman-yor-often", "pitman-yor-states"}
