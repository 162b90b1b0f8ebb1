import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripweave.llm import packing, token_counts
from tripweave.llm.vocab import byte_bpe, default_path, safe_parts

SHAPE = "doc_id long, text string"
ODD = [
    (1, None),
    (2, ""),
    (3, "a<|endoftext|>b  <|endoftext|> x"),
    (4, " \n\n  x " * 500),
    (4, " \n\n  x " * 500),
    (None, "été  ▁ ▁▁x <s> </s> <0x0A> " * 3000),
    (5, "x" * 5000),
    (6, "ab cd " * 60000),
    (7, "日本語のテキスト 12 345  6\t7"),
]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    given_rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    return given_rows + ODD


def test_counts_are_those_of_the_library(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))
    got = token_counts.op9_token_counts(spark.createDataFrame(docs, SHAPE).repartition(5))
    sizes = [len(model.encode(t or "")) for _, t in docs]
    want = Counter((d, len((t or "").encode()), n, n > 4096) for (d, t), n in zip(docs, sizes))
    assert Counter(map(tuple, got.collect())) == want


def test_every_id_lies_in_one_piece_and_sequences_have_no_gaps(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    want = Counter()
    for d, t in docs:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for a in range(0, len(ids), 1024):
            want[(d, a, len(ids[a : a + 1024]), zlib.crc32(ids[a : a + 1024].tobytes()), len(ids))] += 1
    got = packing.op8_packing(spark.createDataFrame(docs, SHAPE).repartition(5)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5)], "doc_id long, text string, length string, n_tokens long")
    assert packing.op8_packing(docs.where("false")).count() == 0
    assert token_counts.op9_token_counts(docs.where("false")).count() == 0
    assert packing.op8_packing(docs).count() == 1
    out = token_counts.with_token_counts(docs, default_path("piece_bpe_32k.model")).first()
    assert (out.length, out.n_tokens, out.over_limit) == ("x", 2, False)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_patterns_place_every_length(counts):
    placed = Counter()
    for lengths, packs in packing.pack_histogram(counts, 64):
        assert packs > 0 and sum(lengths) <= 64
        for length in lengths:
            placed[length] += packs
    assert placed == Counter(counts)


def test_little_padding_where_lengths_are_mixed():
    rng = random.Random(2)
    counts = Counter(rng.randint(1, 1023) for _ in range(20000))
    patterns = packing.pack_histogram(counts, 1024)
    tokens = sum(k * v for k, v in counts.items())
    assert tokens / (1024 * sum(packs for _, packs in patterns)) > 0.99


@given(st.lists(st.sampled_from(["ab", " ", "  ", "\n", "é", "1", "'s", "<|endoftext|>", "日", "!"]), max_size=60))
@settings(max_examples=100, deadline=None)
def test_cutting_at_safe_places_changes_no_ids(parts):
    text = "".join(parts)
    ids = byte_bpe(default_path("byte_bpe_50k.json"))
    cut = [list(ids(p)) for p in safe_parts(text, 3)]
    assert sum(cut, []) == list(ids(text))


LONG_RUNS = {
    "blanks": "one" + " " * 2_000_000 + "two",
    "line ends": "\n" * 2_000_000,
    "mixed": "x" + " \t\n\r\x0b\x0c\u00a0\u3000" * 250_000 + " end",
    "one letter": "a" * 2_000_000,
    "several runs": ("word" + " " * 60_000) * 3 + "<|endoftext|>" + "\t" * 70_000 + " x y" * 9,
}


def test_long_runs_are_packed_with_the_ids_of_the_own_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    docs = list(enumerate(LONG_RUNS.values()))
    want = Counter()
    for d, t in docs:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for a in range(0, len(ids), 1024):
            want[(d, a, len(ids[a : a + 1024]), zlib.crc32(ids[a : a + 1024].tobytes()), len(ids))] += 1
    got = packing.op8_packing(spark.createDataFrame(docs, SHAPE)).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want


def test_long_runs_are_counted_as_the_library_does(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))
    docs = list(enumerate(LONG_RUNS.values()))
    got = {r.doc_id: r.n_tokens for r in token_counts.op9_token_counts(spark.createDataFrame(docs, SHAPE)).collect()}
    assert got == {d: len(model.encode(t)) for d, t in docs}
