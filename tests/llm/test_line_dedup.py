import hashlib
import random

from chartloom.llm import line_dedup


def chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    c = [((h[k - 1] if k else 0) * 1_000_003 + h[k]) % (2**31 - 1) % 3 == 0 for k in range(len(h))]
    out, begin = [], 0
    for k in range(len(lines)):
        if k == len(lines) - 1 or (c[k] and not (k and c[k - 1])):
            out.append(lines[begin : k + 1])
            begin = k + 1
    return out


def brute(docs):
    seen, out = set(), []
    rank = lambda r: (float("inf") if r[0] is None else r[0])
    for i, text in sorted(docs, key=rank):
        kept, removed = [], 0
        parts = chunks(text) if text is not None else []
        for part in parts:
            body = "\n".join(part)
            if len(part) >= 2 and body.strip():
                if body in seen:
                    removed += len(part)
                    continue
                seen.add(body)
            kept.append(body)
        out.append((i, sum(map(len, parts)), removed, "\n".join(kept)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice("alpha beta gamma delta é".split()) + str(rng.randint(0, 99)) for _ in range(4))
    passage = [line() for _ in range(14)]
    docs = []
    for i in range(40):
        lines = [line() for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.6:
            a = rng.randint(0, 6)
            at = rng.randint(0, len(lines))
            lines[at:at] = passage[a : a + rng.randint(2, 8)]
        docs.append((i, "\n".join(lines)))
    docs += [(50, None), (51, ""), (52, "\n\n\n"), (53, "\n\n\n\n"), (54, "one line"), (55, "one line"), (56, "\n".join(passage)), (57, "\n".join(passage)), (None, "\n".join(passage))]
    docs += [(58, "\n".join(["same"] * 9)), (59, "\n".join(line() for _ in range(3000)))]
    return docs


def test_same_as_brute_force(documents):
    docs = corpus()
    got = sorted((tuple(r) for r in line_dedup.summary(documents(*docs)).collect()), key=repr)
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 50


def test_documents_keep_their_columns(documents):
    docs = corpus()
    frame = documents(*docs)
    out = line_dedup.remove_repeats(frame)
    assert out.schema == frame.schema
    texts = {(r.doc_id, r.text) for r in out.collect()}
    want = {(i, t) for i, _, n, t in brute(docs) if n == 0 or t.strip()}
    assert {(i, t or "") for i, t in texts} == want
    assert (57, "\n".join([])) not in texts


def test_a_line_in_front_moves_no_other_border():
    lines = [f"line {k}" for k in range(200)]
    a = {tuple(c) for c in chunks("\n".join(lines))}
    b = {tuple(c) for c in chunks("\n".join(["new", *lines]))}
    assert len(a & b) > 0.9 * len(a)


def test_empty_table(documents):
    assert line_dedup.summary(documents((1, "x")).limit(0)).collect() == []


def test_helper_names_of_the_table(documents):
    body = "\n".join(f"line {k}" for k in range(40))
    names = ("__doc", "__version", "__chunks", "__gone", "__left", "__lines", "___parts")
    docs = documents((1, body), (2, body), (3, "x\ny")).selectExpr("*", *(f"'{n}' AS {n}" for n in names))
    out = line_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert sorted(r.doc_id for r in rows if r.text == body) == [1]
    assert all(r[n] == n for r in rows for n in names)
