"""Where the mix's queue ends, against all packets sorted in plain Python."""

import random

import pytest

from tempograin.llm import mixing


@pytest.mark.parametrize("range_rows", [4_000, 20])
def test_cut_of_the_queue(spark, monkeypatch, range_rows):
    """Long texts reach over many ranges, short ones lie in one; ties of finish times, a null source, empty texts."""
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    r = random.Random(11)
    docs = [(i, "w " * r.choice([0, 1, 31, 32, 33, 64, 500, 6_000]), r.choice(["a", "b", "c", None])) for i in range(120)]
    docs += [(1000 + i, "w " * 32, s) for s in ("d", "e") for i in range(3)]  # alike
    queue = mixing.fair_queue(spark.createDataFrame(docs, "doc_id long, text string, source string"), keep_row=False).cache()
    packets = []
    for d in queue.collect():
        for start in (c * d["source_size"] + d["ahead"] for c in range(mixing.MOST_COPIES)):
            ends = [min(e + mixing.PACKET, d["size"]) for e in range(0, d["size"], mixing.PACKET)]
            packets += [((start + e) / d["target"], d["place"], e - s) for s, e in zip([0, *ends], ends)]
    packets.sort()
    total, before = sum(d["size"] for d in queue.collect()), 0
    for finish, place, words in packets:
        if before + words >= total:
            break
        before += words
    assert mixing.queue_end(queue) == mixing.Cut(finish, place, total - before)
    got = mixing.taken(queue, mixing.queue_end(queue))
    assert got.groupBy().sum("taken").first()[0] == total
