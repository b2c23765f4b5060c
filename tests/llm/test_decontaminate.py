import random

import numpy as np
import pyarrow as pa
import pytest
from cases import corpus, documents, prose

from llm import words as word_tools
from llm.decontaminate import Search, drop_leaks, edit_distance_within, find_leaks, unit_hashes

R = random.Random(11)
VOCABULARY = [a + b + c for a in ("ka", "lo", "mi", "tu", "re", "zo") for b in ("na", "si", "ve", "po") for c in ("", "n", "r", "st")]
ITEMS = [prose(R, n, VOCABULARY) for n in (5, 6, 8, 11, 15, 16, 20, 32, 40, 64, 90)] + ["too short now", None, ""]


def benchmark(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(ITEMS)] + [(None, prose(random.Random(3), 30, VOCABULARY), "x", "y")]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, edits string")


def edited(r, text, edits):
    w = text.split()
    for _ in range(edits):
        k, at = r.random(), r.randrange(len(w))
        if k < 0.4:
            w[at] = r.choice(VOCABULARY)
        elif k < 0.7:
            del w[at]
        else:
            w.insert(at, r.choice(VOCABULARY))
    return " ".join(w)


def slow_edits(item, text):
    """Least edits of the item against any stretch of the text, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def words(text):
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "")).lower().split()


def test_distance_equals_brute_force():
    for _ in range(200):
        a = np.array([R.randrange(5) for _ in range(R.randrange(1, 9))], np.uint64)
        b = np.array([R.randrange(5) for _ in range(R.randrange(0, 14))], np.uint64)
        assert edit_distance_within(a, b)[0] == slow_edits(a.tolist(), b.tolist())


def test_found_pairs_equal_brute_force_and_clean_texts_are_left_alone(spark):
    texts = corpus(12)
    for k, item in enumerate(ITEMS[:11]):
        texts += [item, f"Before, {item.upper()}! after", f"{prose(R, 300)} {item.replace(' ', ',\n')}", f"{item} x {ITEMS[(k + 1) % 11]}"]
    docs = documents(spark, [*texts, (None, ITEMS[9]), (3, ITEMS[8]), (3, ITEMS[8])])
    found = find_leaks(docs, benchmark(spark)).collect()
    want = []
    for r in docs.collect():
        text = words(r["text"])
        for i, item in enumerate(ITEMS[:11]):
            edits = slow_edits(words(item), text)
            if edits <= len(words(item)) // 5:
                want.append((r["doc_id"], i, edits, len(words(item))))
    assert sorted((tuple(r[:4]) for r in found if r[1] is not None), key=str) == sorted(want, key=str)


def test_recall_of_edited_passages(spark):
    r = random.Random(21)
    texts, total = [], 0
    for item in ITEMS[4:11]:
        for _ in range(20):
            texts.append(f"{prose(r, 50)} {edited(r, item, max(1, len(item.split()) // 7))} {prose(r, 50)}")
            total += 1
    found = find_leaks(documents(spark, texts), benchmark(spark)).select("doc_id").distinct().count()
    assert found >= 0.9 * total


def test_blocks_give_the_same(spark):
    docs = documents(spark, [f"a {t} b" for t in ITEMS[:11]])
    one, many = (find_leaks(docs, benchmark(spark), block_words=n) for n in (400_000, 60))
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_documents_with_items_go(spark):
    docs = documents(spark, ["clean words", ITEMS[7], None, ""])
    kept = drop_leaks(docs, benchmark(spark))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    assert find_leaks(docs.limit(0), benchmark(spark)).count() == 0
    assert find_leaks(docs, benchmark(spark).limit(0)).count() == 0
    assert Search().tables == 5


JAPANESE = "次の文章を読んで、正しい答えを一つ選びなさい。"


def test_short_and_unspaced_items(spark):
    items = [(1, "What is two plus"), (2, JAPANESE), (3, "yes"), (4, "so be"), (5, "ประเทศไทยมีกี่จังหวัด"), (6, "2 + 2")]
    rows = [(i, t, "x", "y") for i, t in items]
    table = spark.createDataFrame(rows, "item_id long, text string, doc_id string, edits string")
    texts = ["He asked: what is TWO, plus? No.", f"前{JAPANESE[:10]}{JAPANESE[11:]}後", "yes and no", " Yes! ", "so be it", "So, be.", f"a{items[4][1]}b", "what is two", "2+2", "1+2+2"]
    found = {(r["doc_id"], r["item_id"], r["edits"]) for r in find_leaks(documents(spark, texts), table).collect()}
    assert found == {(1, 1, 0), (2, 2, 1), (4, 3, 0), (6, 4, 0), (7, 5, 0), (9, 6, 0)}


def test_units_equal_a_slow_reading():
    r = random.Random(5)
    kinds = ["ab Z", "é ü", "日本の文", "、。　", "ไทยກ", "한국 말", "!?\n", "😀𠀀", "မြខ"]
    texts = ["".join(r.choice(r.choice(kinds)) for _ in range(r.randrange(0, 30))) for _ in range(300)]

    def slow(text):
        out, run = [], ""
        for c in text + " ":
            alone = any(a <= ord(c) <= b for a, b in ((0xE00, 0xEFF), (0x1000, 0x10BF), (0x1780, 0x17FF), (0x3040, 0x9FFF), (0x20000, 0x2FFFF)))
            if alone or 0x3000 <= ord(c) <= 0x303F or ord(c) < 128 and not c.isalnum():
                out += [run] * bool(run) + [c] * alone
                run = ""
            else:
                run += c.lower() if c.isascii() else c
        return out

    for _, _, data, starts in word_tools.chunks(pa.array(texts)):
        hashes, first = unit_hashes(data, starts)
        for k, text in enumerate(texts):
            parts = [p.encode() for p in slow(text)]
            whole = np.frombuffer(b"".join(parts), np.uint8)
            ends = np.cumsum([len(p) for p in parts]).astype(int)
            want = word_tools.hash_spans(whole, ends - [len(p) for p in parts], ends) if parts else np.zeros(0, np.uint64)
            assert hashes[first[k] : first[k + 1]].tolist() == want.tolist(), text


@pytest.mark.parametrize("length", [3, 5, 6, 8, 12, 20, 40])
def test_recall_with_as_many_edits_as_are_allowed(spark, length):
    r = random.Random(length)
    items = [prose(r, length, VOCABULARY) for _ in range(60)]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(items)], "item_id long, text string, doc_id string, edits string")
    texts, wanted = [], 0
    for item in items:
        texts.append(f"{prose(r, 30)} {edited(r, item, length // 5)} {prose(r, 30)}")
    docs = documents(spark, texts)
    found = {(x["doc_id"], x["item_id"]) for x in find_leaks(docs, table).collect()}
    for d in docs.collect():
        i = d["doc_id"] - 1
        wanted += slow_edits(words(items[i]), words(d["text"])) <= length // 5
    assert wanted >= 55 and len({d for d, i in found if i == d - 1}) >= 0.85 * wanted
