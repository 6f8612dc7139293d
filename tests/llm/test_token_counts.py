import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from floodmark.llm import token_counts
from floodmark.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "\n\n  two  spaces ", "it's 12345 \t x", "é😀 ñandú — 漢字かな", "a<|endoftext|>b", "<|endoftext|>", "a" * 3000,
    "same text", "same text", "!?" * 500, "one two " * 30_000, "word<|endoftext|> word " * 9_000, "漢字" * 40_000, "é \x1c\x1d x  y\x85 z",
]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def documents(spark, texts):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, digest string").repartition(3)


def test_counts_equal_the_library(spark, plain, tmp_path):
    cache = str(tmp_path / "cache")
    docs = documents(spark, TEXTS)
    docs = docs.unionByName(docs.filter("doc_id in (4, 9)")).unionByName(docs.filter("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    out = token_counts.count_tokens(docs, PATH, cache)
    assert out.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 3
    for r in rows:
        text = TEXTS[5 if r.doc_id is None else r.doc_id]
        want = plain(text)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((text or "").encode()), want, want > 512)


def test_only_distinct_misses_are_encoded_and_stored(spark, plain, tmp_path, monkeypatch):
    cache = str(tmp_path / "cache")
    first, second = ["a b", "a b", "c", None, ""], ["c", "d e f", "d e f", "a b"]
    token_counts.count_tokens(documents(spark, first), PATH, cache).collect()
    assert spark.read.parquet(cache).count() == 3
    # A marked count shows that a stored digest is not encoded again.
    stored = spark.read.parquet(cache).withColumn("n_tokens", F.col("n_tokens") + 1000)
    marked = str(tmp_path / "marked")
    stored.unionByName(stored.limit(2)).write.parquet(marked)
    rows = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(spark, second), PATH, marked).collect()}
    assert rows == {0: plain("c") + 1000, 1: plain("d e f"), 2: plain("d e f"), 3: plain("a b") + 1000}
    assert spark.read.parquet(marked).count() == 3 + 2 + 1
    # The shuffle join for many misses finds the same, and another tokenizer version finds nothing stored.
    monkeypatch.setattr(token_counts, "BROADCAST_MISSES", 0)
    rows = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(spark, second + ["g"]), PATH, marked).collect()}
    assert rows[4] == plain("g") and rows[0] == plain("c") + 1000
    monkeypatch.setattr(token_counts, "version", lambda data: "another")
    rows = [r.n_tokens for r in token_counts.count_tokens(documents(spark, ["c"]), PATH, marked).collect()]
    assert rows == [plain("c")]


def test_hot_text_and_empty_table(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT_ROWS", 10)
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot one").otherwise(F.concat(F.lit("t "), "id")).alias("text"))
    rows = token_counts.count_tokens(docs, PATH, str(tmp_path / "hot")).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == [(i, plain("hot one" if i % 3 == 0 else f"t {i}")) for i in range(900)]
    assert token_counts.count_tokens(docs.limit(0), PATH, str(tmp_path / "none")).collect() == []
    nothing = docs.limit(4).withColumn("text", F.lit(None).cast("string"))
    assert [(r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(nothing, PATH, str(tmp_path / "nulls")).collect()] == [(0, 0)] * 4


def test_parts_have_the_tokens_of_the_whole(plain):
    with open(PATH, "rb") as f:
        counter = token_counts.Counter(f.read())
    text = ("Some  words, 12 numbers\n and 漢字 ñ's. " * 6000)[:200_000]
    assert len(counter.parts(text)) > 2 and "".join(counter.parts(text)) == text
    assert counter.count([text, "", "x"]) == [plain(text), 0, 1]


def test_query(spark, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = LLM_QUERIES["op13_token_counts"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[r.doc_id] or "").encode()), want, want > 512)
