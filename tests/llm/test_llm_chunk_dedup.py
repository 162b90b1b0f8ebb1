import random

import numpy as np

from tripweave.llm import chunk_dedup
from tripweave.llm.chunk_dedup import LONGEST, WINDOW, chunk_ends, gear

SHAPE = "doc_id long, text string"


def prose(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choices("abcdefghijklmnop  ", k=n))


def test_hash_is_that_of_a_loop():
    data = np.frombuffer(prose(1, 200).encode(), np.uint8)
    h, out = 0, []
    for b in data:
        h = (2 * h + int(chunk_dedup._GEAR[b])) % 2**16
        out.append(h)
    assert gear(data).tolist() == out


def test_an_insertion_moves_only_the_boundaries_next_to_it():
    text = prose(2, 5000)
    longer = text[:2000] + "INSERTED" + text[2000:]
    ends = [set(chunk_ends(np.frombuffer(t.encode(), np.uint8), np.zeros(1, np.int64)).tolist()) for t in (text, longer)]
    assert {e for e in ends[0] if e < 2000} == {e for e in ends[1] if e < 2000}
    assert {e for e in ends[0] if e > 2000 + WINDOW} == {e - 8 for e in ends[1] if e > 2008 + WINDOW}


def test_texts_are_cut_alike_in_any_company():
    texts = [prose(k, n).encode() for k, n in ((3, 700), (4, 5), (5, 9000))] + [b"\0" * 3 * LONGEST]
    alone = [chunk_ends(np.frombuffer(t, np.uint8), np.zeros(1, np.int64)) for t in texts]
    opens = np.cumsum([0, *map(len, texts)])[:-1]
    together = chunk_ends(np.frombuffer(b"".join(texts), np.uint8), opens)
    assert together.tolist() == [int(e + o) for ends, o in zip(alone, opens) for e in ends]
    assert np.diff(alone[3]).max() <= LONGEST


def test_one_copy_of_a_passage_stays(spark):
    passage = prose(6, 800)
    rows = [(k, prose(10 + k, 600) + passage + prose(20 + k, 300)) for k in range(4)]
    rows += [(50, prose(50, 500)), (51, prose(50, 500)), (51, prose(50, 500)), (None, prose(50, 500)), (60, None), (61, ""), (62, "tiny"), (63, "tiny")]
    docs = spark.createDataFrame(rows, SHAPE).repartition(5)
    out = chunk_dedup.without_copies(docs).collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.copies)
    cut = [by[k][0].n_removed for k in range(4)]
    assert sorted(c > 600 for c in cut) == [False, True, True, True] and 0 in cut and max(cut) <= 800, cut
    for k in range(4):
        spans = by[k][0].spans
        assert all(s.start >= 600 and s.end <= 1400 for s in spans)
        assert len(by[k][0].kept) + cut[k] == by[k][0].n_bytes
    # Of equal texts the least id keeps its own, rows equal in id and text do alike.
    assert by[50][0].n_removed == 0 and [c.n_removed for c in by[51]] == [500, 500] and by[None][0].n_removed == 500
    assert [by[k][0].n_bytes for k in (60, 61, 62, 63)] == [0, 0, 4, 4] and by[63][0].n_removed == 0


def test_a_text_keeps_the_first_of_its_own_repeats(spark):
    passage = prose(7, 500)
    rows = [(1, passage + "." * 50 + passage + "-" * 50 + passage)]
    r = chunk_dedup.without_copies(spark.createDataFrame(rows, SHAPE)).first().copies
    assert len(r.spans) == 2 and r.spans[0].start >= 550 and 800 < r.n_removed <= 1000


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, prose(1, 300), "x", 2)], "doc_id long, text string, h1 string, pos long")
    assert chunk_dedup.op1_chunk_dedup(docs.where("false")).count() == 0
    r = chunk_dedup.without_copies(docs).first()
    assert (r.h1, r.pos, r.copies.n_removed) == ("x", 2, 0)
