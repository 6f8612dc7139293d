import hashlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from floodmark.llm import bpe

from tests.llm import test_decontaminate, test_near_dedup, test_personal, test_quality

SF = "/root/testdata/sf0.001"


def test_run_equals_plain_stages(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    items = [r.text.encode().lower().split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r[0] for r in test_quality.plain(docs) if r[-1]}
    docs = [(i, t) for i, t, _ in docs if i in kept]
    classes = test_near_dedup.plain(docs)
    docs = [(i, t) for i, t in docs if classes[i][1] == i]

    def leaks(text):
        words = text.encode().lower().split()
        held = set(words)
        return any(
            x and sum(w in held for w in x) >= len(x) - len(x) // 5 and test_decontaminate.edits(x, words) <= len(x) * 20 // 100
            for x in items)

    docs = [(i, t) for i, t in docs if not leaks(t)]
    masked = {}
    spans = test_personal.plain(docs)
    for i, t in docs:
        at, out = 0, []
        for kind, a, e in sorted((x.split(":") for x in spans[i][-1].split(",") if x), key=lambda s: (int(s[1]), int(s[2]))):
            a, e = int(a), int(e)
            if e > at:
                out += [t[at : max(a, at)], f"<{kind}>"]
                at = e
        masked[i] = "".join(out) + t[at:]
    with open(corpus_pipeline.RANKS, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for i, t in masked.items():
        ids = np.array(enc.encode_ordinary(t), dtype="<u4")
        want[i] = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < 200


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.collect() == []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "benchmark_decontamination", "pii", "byte_level_bpe"]
