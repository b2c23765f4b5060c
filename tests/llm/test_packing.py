import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import corpus, documents
from tokenizers import Tokenizer

from llm.packing import WordEncoder, best_fit, cut, fit_patterns, pack_documents, plan_sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_cut_ids_equal_whole_texts(tokenizer):
    pieces = ["a", " ", "  ", "\n", "\t", "Ünï", "don't", "<|endoftext|>", "12,5", " ", "x\ny", "日本", " ", ""]
    r = random.Random(5)
    texts = ["".join(r.choice(pieces) + r.choice(("", " ", " ")) for _ in range(r.randrange(12))) for _ in range(3000)]
    texts += [t or "" for t in corpus()]
    encoder = WordEncoder(PATH, limit=200)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_every_piece_is_packed_once(spark, tokenizer):
    docs = documents(spark, [*corpus(2), (None, "a b"), (3, "again"), (3, "again")])
    out = pack_documents(docs, PATH, most=64).collect()
    want = []
    for r in docs.collect():
        ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        for piece, (start, length) in enumerate(cut(len(ids), 64)):
            want.append((r["doc_id"], piece, start, length, zlib.crc32(ids[start : start + length].tobytes())))
    assert sorted((tuple(r[:5]) for r in out), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 64
    assert len(sequences) <= 1.02 * -(-sum(r["length"] for r in out) // 64) + 1


def test_empty_table(spark):
    assert pack_documents(documents(spark, ["a"]).limit(0), PATH).count() == 0


def test_cut_shortens_only_the_first_piece():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(1, 4) == [(0, 1)]


def test_plans_hold_all_lengths():
    r = np.random.default_rng(3)
    for most in (1, 7, 64, 256):
        for _ in range(8):
            counts = np.append(0, r.integers(0, 40, most) * (r.random(most) < r.random()))
            for plan in (plan_sequences(counts, most), best_fit(counts, most)):
                held = np.zeros(most + 1, int)
                for contents, n in plan:
                    assert sum(contents) <= most and n > 0
                    for length in contents:
                        held[length] += n
                assert (held == counts).all()


def test_fit_is_a_non_negative_least_square():
    counts = np.array([0, 4, 2, 6])
    patterns = [(1, 2), (1, 3), (3,)]
    x = fit_patterns(counts, patterns, 500)
    a = np.array([[0, 0, 0], [1, 1, 0], [1, 0, 0], [0, 1, 1]])
    slope = a.T @ (a @ x - counts)
    assert (x >= 0).all() and (slope > -0.05).all() and abs(slope @ x) < 0.5


def test_added_tokens_are_encoded_as_the_plain_library_does(spark):
    plain = Tokenizer.from_file(PATH)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "a b<|endoftext|>c", "<|endoftext|><|endoftext|> x", "one <|endoftext| > two"]
    assert plain.encode(texts[0], add_special_tokens=False).ids == [505, 220, 50256, 734]
    out = pack_documents(documents(spark, texts), PATH, most=64).collect()
    found = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in out}
    for i, text in enumerate(texts, 1):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert found[i] == (len(ids), zlib.crc32(ids.tobytes())), text


def test_parts_of_words_have_the_ids_of_the_library():
    plain = Tokenizer.from_file(PATH)
    r = random.Random(8)
    kinds = ["abcXYZ", "éßÑŁɏÀ", "0129", ".,;:!?-_/()[]{}$%&*#@+=<>|~^`\"\\", "\n", "'", "中ª²½µ×÷", "\t\r\x0b\x85\u00a0", " "]
    weights = [30, 10, 8, 10, 3, 2, 2, 1, 12]
    texts = ["".join(r.choice(r.choices(kinds, weights)[0]) for _ in range(r.randrange(1, 60))) for _ in range(4000)]
    encoder = WordEncoder(PATH, added_as_text=False)
    assert encoder.by_rule
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert list(np.frombuffer(ids, "<u4")) == plain.encode(text, add_special_tokens=False).ids, text
