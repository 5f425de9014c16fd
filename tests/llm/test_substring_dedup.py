import random
import re

import pytest

from chartloom.llm import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs):
    earliest = {}
    texts = [(i, WORD.findall(t or "")) for i, t in docs]
    rank = lambda i: float("inf") if i is None else i
    for i, ws in texts:
        for k in range(len(ws) - 49):
            key = tuple(ws[k : k + 50])
            earliest[key] = min(earliest.get(key, float("inf")), rank(i))
    out = []
    for i, ws in texts:
        gone = set()
        for k in range(len(ws) - 49):
            if earliest[tuple(ws[k : k + 50])] < rank(i):
                gone.update(range(k, k + 50))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}é" for k in range(400)] + ["the", "of", "a"] * 40
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [prose(rng.choice([49, 50, 51, 60, 130])) for _ in range(6)]
    docs = []
    for i in range(60):
        ws = prose(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(ws))
            ws[at:at] = rng.choice(passages)
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(ws)))
    base = prose(300)
    for i in range(60, 75):
        ws = list(base)
        ws[rng.randint(0, 299)] = f"edit{i}"
        docs.append((i, " ".join(ws)))
    docs += [(80, " ".join(["Inin"] * 400)), (81, " ".join(["Inin"] * 70)), (82, " ".join(["a", "b"] * 200)), (83, " ".join(["b", "a"] * 60))]
    docs += [(90, None), (91, ""), (92, " \n"), (5, docs[5][1]), (6, docs[7][1]), (None, docs[8][1]), (None, " ".join(base))]
    docs += [(95, " ".join(prose(20000) + passages[0]))]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(documents, seed):
    docs = corpus(seed)
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(documents(*docs)).collect()), key=repr)
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 1000


def test_empty_table(documents):
    assert substring_dedup.remove_repeats(documents((1, "x")).limit(0)).collect() == []


def test_words_that_differ_are_told_apart(documents, alike_words):
    words = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join([*words[:30], own, *words[30:]])) for k, own in enumerate(alike_words)]
    docs += [(2, docs[0][1])]
    got = substring_dedup.remove_repeats(documents(*docs)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, (r.kept or b"").decode() if isinstance(r.kept, (bytes, bytearray)) else r.kept) for r in got), key=repr) == brute(docs)
