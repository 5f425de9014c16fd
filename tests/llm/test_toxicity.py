import random

import numpy as np
from pyspark.sql import functions as F

from chartloom.llm import toxicity
from chartloom.llm.rows import fold


def corpus():
    rng = random.Random(12)
    words = "house thing water stone river mountain clear green table über été".split()
    docs, labels = [], []
    for i in range(600):
        ws = [rng.choice(words) + rng.choice(["", "s", "er"]) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                ws.insert(rng.randint(0, len(ws)), rng.choice(["grobian", "blargh" + rng.choice(["en", "s", "ia", "ul", "xo", "qi"])]))
        docs.append((i, " ".join(ws) + "."))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out(documents, spark):
    docs, labels = corpus()
    frame = documents(*docs, (900, None), (901, ""), (902, "!!"), (None, "you grobian"), (903, "water " * 20000 + "grobian"), (1, docs[1][1]))
    marks = spark.createDataFrame([*labels, labels[3], (None, 1), (700, None)], "doc_id long, toxic int")
    held = fold("doc_id", 5) == 0
    model = toxicity.fit(frame, marks, ~held)
    rows = toxicity.score(frame, model).withColumn("held", held).collect()
    assert len(rows) == 606
    truth = dict(labels)
    own = [(r.predicted, truth[r.doc_id]) for r in rows if r.held and r.doc_id in truth]
    assert np.mean([a == b for a, b in own]) > 0.97
    got = {r.doc_id: r for r in rows}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert not any(got[i].predicted for i in (900, 901, 902))
    assert got[None].predicted
    assert got[903].predicted


def test_grammar_reads_the_clause():
    model = toxicity.Model({"oaf": 4.0}, {"blar": 3.0})
    worth = lambda text: model.clause(text.split())
    assert worth("an oaf") == 4.0
    assert worth("you oaf") > worth("an oaf") > worth("he said oaf") > worth("not an oaf") > 0
    assert worth("said you not really oaf") == 4.0 * toxicity.NEGATED * toxicity.REPORTED * toxicity.AIMED
    assert worth("not one two three four oaf") == 4.0
    assert worth("blarx") == 3.0
    assert model.features("oaf. you!")[1] < model.features("you oaf!")[1]
    assert model.features("kill the water.") == (0.0, 0.0)
    assert model.features("i kill you.")[0] > 0


def test_exceptions_below_a_beginning():
    model = toxicity.lexicon([("blar*", 30, 31), ("blarney", 0, 40), ("blarg*", 20, 20), ("water", 1, 60)], 50, 200)
    assert model.insult("blarxx") > toxicity.ODDS
    assert model.insult("blarney") == 0
    assert model.insult("water") == 0


def test_without_labels(documents, spark):
    frame = documents((1, "text"), (2, None))
    model = toxicity.fit(frame, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), F.lit(True))
    assert [r.score for r in toxicity.score(frame, model).collect()] == [0.0, 0.0]
    assert toxicity.score(frame.limit(0), model).collect() == []
