import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chartloom.llm import language_id
from chartloom.llm.texts import pieces

VOICES = {"aa": "the of and thing ation er house", "bb": "der und die schön keit zug", "cc": "le la été eau que oiseau"}


def prose(rng, lang, n):
    parts = VOICES[lang].split()
    return " ".join(rng.choice(parts) + rng.choice(["", rng.choice(parts)]) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    return [(i, prose(rng, lang := rng.choice(list(VOICES)), rng.randint(1, 80)), lang) for i in range(400)]


def test_held_out_accuracy_and_special_texts(spark, corpus):
    rows = [*corpus, (900, None, "aa"), (901, "", "bb"), (902, "12 !? ...", "cc"), (905, "½ ²", "aa"), (906, "Ⅷ ①", "bb"), (903, prose(random.Random(1), "cc", 30000), None), (None, "the of and", None), (904, "der und die schön", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.fit(docs, F.coalesce(F.col("doc_id"), F.lit(0)) % 3 != 1)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    held = [(got[i].lang_pred, lang) for i, _, lang in corpus if i % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    for i in (900, 901, 902, 905, 906):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert (got[903].lang_pred, got[904].lang_pred, got[None].lang_pred) == ("cc", "bb", "aa")
    kept = language_id.accepted(docs, model)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}
    assert sum(r.rejected for r in got.values()) <= 14


def test_foreign_text_is_less_certain(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string, lang string")
    model = language_id.fit(docs, F.lit(True))
    odd = spark.createDataFrame([(1, "Ω≈ç√∫ кириллица это другой язык", None)], "doc_id long, text string, lang string")
    sure = np.mean([r.score for r in language_id.predict(docs, model).collect()])
    assert language_id.predict(odd, model).first().score < sure


def test_grams_stay_in_their_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab", "", "c", "déf  g!!", None, "ab"])], ["text"])
    (piece,) = pieces(iter([batch]))
    orders, places, counts = language_id.grams(piece)
    alone = [language_id.grams(next(pieces(iter([pa.RecordBatch.from_arrays([pa.array([t])], ["text"])])))) for t in ("ab", "c", "déf  g!!")]
    for k, other in zip((0, 2, 3), alone):
        for mine, theirs in zip(orders, other[0]):
            own = mine[places[k] : places[k + 1]]
            assert sorted(own[own < language_id.BUCKETS]) == sorted(theirs[theirs < language_id.BUCKETS])
        assert counts[k] == other[2][0]


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language_id.fit(docs, F.lit(True)) is None
    assert language_id.predict(docs, None).first().lang_pred == "und"
    assert language_id.predict(docs.limit(0), None).collect() == []
