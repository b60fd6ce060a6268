"""Rounds of packing on lengths that few bins can fill."""

from corpusloom.llm import packing


def test_open_bins_meet_those_of_other_blocks(spark):
    """Pieces of 60 and 40 fill bins in pairs only; in a small block one kind is left over, more than an eighth of it."""
    rows = [(i, 0, 0, 60 if i % 2 else 40, i) for i in range(1200)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECE), 100, block_pieces=24).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(i, n) for i, _, _, n, _ in rows]
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(x) in ([(0, 60), (60, 40)], [(0, 40), (40, 40)], [(0, 60)], [(0, 40)]) for x in held.values())
    assert len(held) <= 615, len(held)


def test_pieces_that_pair_with_none(spark):
    """No round can lower the number of bins."""
    rows = [(i, 0, 0, 51 + i % 7, i) for i in range(300)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECE), 100, block_pieces=50).collect()
    assert sorted(r.doc_id for r in got) == list(range(300)) and len({r.sequence_id for r in got}) == 300
