import hashlib
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import tiktoken
from pyspark.sql import functions as F
from test_decontaminate import brute as hits
from test_jaccard_join import brute as groups
from test_line_dedup import brute as thinned

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from chartloom.llm import bpe, language_id  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_copies", "decontamination", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Rows that the table lacks: no text, no letters, an extra column, a doubled row, a null id.
    extra = docs.limit(1).withColumn("doc_id", F.lit(None).cast("long"))
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "12 34 !?", "en", "s", 8), (9003, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(docs.limit(4)).unionByName(extra).unionByName(odd).withColumn("version", F.lit("x"))
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        seen[name] = (before.collect(), docs.collect())
        if name != "tokens":
            assert docs.columns == before.columns
    text = lambda rows: [(r.doc_id, r.text) for r in rows]
    before, after = seen["language"]
    assert {9001, 9002, 9003} & {r.doc_id for r in before} and not {9001, 9002, 9003} & {r.doc_id for r in after}
    assert len(after) >= len(before) - 5
    before, after = seen["lines"]
    once = {}
    for i, t in text(before):
        once[i, t] = once.get((i, t), 0) + 1
    assert set(text(after)) == {(i, t) for i, _, n, t in thinned(list(once)) if n == 0 or t.strip()}
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = seen["near_copies"]
    linked = groups(text(before), 5, 80)
    assert len(after) == len({g for _, n, g in linked if n}) + sum(n == 0 for _, n, _ in linked)
    assert {r.doc_id for r in after} == {g for _, _, g in linked}
    before, after = seen["decontamination"]
    want = [i for i, n, hit, _ in hits(text(before), items) if not (hit and 20 * hit >= n)]
    assert sorted((r.doc_id for r in after), key=str) == sorted(want, key=str)
    before, after = seen["tokens"]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    texts = dict(text(before))
    for r in after:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert bytes(r.ids) == ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())
    assert len(after) == len(before) > 50


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 50
    assert language_id.fit(spark.read.parquet(f"{SF}/documents.parquet"), F.lit(True)) is not None


def test_run_leaves_one_table(spark):
    """Tables of earlier stages, and what stages write on their way, do not pile up."""
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(root.iterdir()) if root.exists() else set()
    out = corpus_pipeline.run(spark, SF)
    assert [p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before] == ["pipeline-decontamination"]
    assert out.count() > 50
