import hashlib
import random

import pytest
from cases import corpus, documents

from llm.fill_in_middle import PLAIN, Spec, Splitter, arranged, cuts, fim_digests, fim_pieces, fim_texts, in_output_order


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(doc_id, text):
    """The contract, text by text."""
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(text)
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = text[:a], text[a:b], text[b:]
    spm = h4 % 100 < 20
    output = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, "spm" if spm else "psm", a, b - a, sha(output), sha(text)


TEXTS = corpus(3) + ["<P", "S>", "<M>", "a <P> b", "<<S", "<S<", "ends in <", "😀" * 50 + "ß", "é", "P><S", "\x00 nul"]


@pytest.mark.parametrize("unit", [1, 7, 4096])
def test_digests_equal_the_contract(spark, unit):
    texts = TEXTS if unit > 1 else [t for t in TEXTS if len(t or "") < 900]
    repeated = [(5, "once more"), (5, "once more"), (5, "another text"), (None, "no id"), (None, "no id"), (9, None)]
    docs = documents(spark, texts + repeated, first=100)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = sorted((tuple(r) for r in fim_digests(docs, unit=unit).collect()), key=str)
    assert found == sorted((wanted(*p) for p in pairs), key=str)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_outputs_and_pieces(spark):
    docs = documents(spark, TEXTS, first=100)
    want = {}
    for r in docs.collect():
        form, a, b = cuts(r["doc_id"], r["text"] or "", Spec())
        want[r["doc_id"]] = (arranged(r["text"] or "", form, a, b), form)
    assert {r["doc_id"]: (r["text"], r["form"]) for r in fim_texts(docs, unit=50).collect()} == want
    pieces = fim_pieces(docs, unit=50).collect()
    assert max(len(r["piece"]) for r in pieces) <= 50
    assert sum(len(r["piece"]) for r in pieces) == sum(len(t) for t, _ in want.values())
    assert cuts(3, "some text", Spec(transformed=0))[0] == PLAIN
    assert {cuts(i, "some text", Spec(transformed=100, suffix_first=100))[0] for i in range(50)} == {"spm"}


def test_sentinels_are_found_wherever_pieces_end():
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice("<PSM>é") for _ in range(r.randrange(1, 30)))
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        for form in ("psm", "spm"):
            a, b = sorted((r.randrange(len(text) + 1), r.randrange(len(text) + 1)))
            output, splitter, parts = arranged(text, form, a, b), Splitter(form), []
            while output:
                k = r.randrange(1, 5)
                parts += splitter.feed(output[:k])
                output = output[k:]
            parts += splitter.end()
            assert "".join(t for _, _, t in sorted(parts)) == text


def test_one_shuffle_and_bounded_rows(spark):
    docs = documents(spark, ["x" * 500_000, "y"])
    plan = fim_digests(docs, unit=1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2
    ordered = in_output_order(fim_pieces(docs, unit=1000))
    assert ordered.count() == 501 or ordered.count() == 502


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert fim_digests(docs).collect() == [] and fim_texts(docs).collect() == []
