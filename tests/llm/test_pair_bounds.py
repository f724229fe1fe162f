"""Exchanges of the Jaccard join: bitmaps, the pairs whose sets are fetched, the filter of documents."""

import numpy as np

from hearth.llm import common, pair_blocks


def test_bitmaps_have_two_to_four_places_a_hash():
    for n in (33, 64, 65, 500, 4096):
        bits = pair_blocks.bitmap(np.arange(n, dtype=np.int64) * 2_654_435_761)
        assert 2 * n <= 8 * len(bits) <= 4 * n


def test_pairs_are_ruled_out_before_their_sets_are_fetched(spark):
    rng = np.random.default_rng(3)
    sets = {1: rng.integers(-(2**62), 2**62, 300)}
    sets[2] = np.r_[sets[1][:290], rng.integers(-(2**62), 2**62, 5)]  # links with 1
    sets[3] = np.r_[sets[1][:40], rng.integers(-(2**62), 2**62, 900)]  # does not, and has a longer bitmap
    rows = [(k, len(s), bytearray(pair_blocks.bitmap(s))) for k, s in sets.items()]
    rows.append((3, 295, bytearray(pair_blocks.bitmap(sets[2]))))  # a second set of 3, which links with 1 and 2
    facts = spark.createDataFrame(rows, "node long, n long, bits binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    one_set = facts.where("not (node = 3 and n = 295)")
    assert [tuple(r) for r in pair_blocks.may_reach(pairs, one_set, 80).collect()] == [(1, 2)]
    assert sorted(tuple(r) for r in pair_blocks.may_reach(pairs, facts, 80).collect()) == [(1, 2), (1, 3), (2, 3)]


def test_filter_is_read_as_packed(spark):
    nodes = spark.createDataFrame([(i * 37,) for i in range(500)], "node long")
    packed = common.key_filter(nodes)
    places = np.arange(0, common.key_filter.bits, 3)
    assert (common.in_filter(packed, places) == np.unpackbits(packed).astype(bool)[places]).all()
