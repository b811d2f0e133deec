"""Token counts against the library itself."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from urlsift.llm import queries, token_counts
from urlsift.llm.common import read

PATH = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "", " ", "  ", "   x", "a  b", "a   b\n\n  c", "\n \n", "\t\tx", "it's I'll we've 'S ''s '' 's", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>",
    "<|endoftext| endoftext|>", "x" * 5000, "漢字かな交じり文 한국어 العربية हिन्दी", "😀👍🏽 é", "՘֋ ౜1 Ᲊa", "\x00\x1c\x85  　", "½²①Ⅷ 1234567890",
    "tail  ", "tail \n ", "a\r\nb", "\U0003fc3f \U0001f9ff", "word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_hard_texts_with_and_without_a_table(library, monkeypatch):
    with open(PATH) as f:
        counter = token_counts.TokenCounter(f.read())
    assert [counter.count(t) for t in HARD] == [want(library, t) for t in HARD]
    counter.table = counter.lengths([" word", "x", " b"])
    monkeypatch.setattr(token_counts, "PART", 7)
    monkeypatch.setattr(token_counts, "CACHE", 3)
    assert [counter.count(t) for t in HARD] == [want(library, t) for t in HARD]


def test_random_texts_cut_anywhere(library, monkeypatch):
    import random

    with open(PATH) as f:
        counter = token_counts.TokenCounter(f.read())
    monkeypatch.setattr(token_counts, "PART", 3)
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n\t ab1!'sé漢՘") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    assert [counter.count(t) for t in texts] == [want(library, t) for t in texts]


def test_every_document(spark, sf, library):
    rows = queries.op11_token_counts(spark, sf).collect()
    texts = {r.doc_id: r.text for r in read(spark, sf, "documents").select("doc_id", "text").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = want(library, texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), n, n > 1024)


def test_messy_rows(spark, messy, library):
    counter = token_counts.fit_counter(messy, F.col("text"), PATH, table=50)
    assert 0 < len(counter.table) <= 100
    for r in messy.select("text", token_counts.tokens(spark, counter, F.col("text")).alias("n")).collect():
        assert r.n == want(library, r.text)


def test_no_rows(spark, nothing):
    counter = token_counts.fit_counter(nothing, F.col("text"), PATH)
    assert counter.table == {} and nothing.select(token_counts.tokens(spark, counter, F.col("text"))).collect() == []


def test_other_kinds_of_vocabularies_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json")) as f, pytest.raises(ValueError, match="byte-level"):
        token_counts.TokenCounter(f.read())
