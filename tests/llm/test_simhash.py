import random

import xxhash

from tests.llm.helpers import linked_classes, prose
from tierline.llm import simhash
from tierline.llm.common import Tables
from tierline.llm.components import components


def plain_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_equals_plain_count():
    for seed in range(20):
        text = prose(seed, seed * 7)
        assert simhash.fingerprint(text, 4) == plain_fingerprint(text, 4)
    assert simhash.fingerprint(None, 4) == simhash.fingerprint(" \n", 4) == 0
    assert simhash.fingerprint("ÀB c", 4) == xxhash.xxh64_intdigest("Àb c".encode(), 42)


def links(spark, values, direct, distance=4):
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in set(values)], "fp long")
    tables = Tables(spark)
    found = components(simhash.links(frame, distance, tables, direct), tables)
    return {r["node"] % (1 << 64): r["component"] for r in found.collect()}


def test_links_equal_all_pairs_also_where_keys_are_crowded(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) for c in centres for _ in range(8)}
    values = sorted(v % (1 << 64) for v in values) + [0, 1, 31, 33]
    expected = linked_classes(values, lambda a, b: (a ^ b).bit_count() <= 4)
    for direct in (1000, 2):
        got = links(spark, values, direct)
        for a in values:
            for b in values:
                same = a == b or (a in got and b in got and got[a] == got[b])
                assert same == (expected[a] == expected[b])


def test_keys_known_as_crowded_give_the_same_links(spark, monkeypatch):
    rng = random.Random(6)
    values = [(c << 40) | rng.getrandbits(18) for c in (3, 9) for _ in range(60)]
    expected = links(spark, values, 1000)
    monkeypatch.setattr(simhash, "SAMPLED", 0.9)
    monkeypatch.setattr(simhash, "FEWEST", 8)
    frame = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    assert not simhash._crowded_keys(frame, simhash._layout(4, len(values)), 10).isEmpty()
    assert links(spark, values, 10) == expected


def test_index_entries_move_once(spark, monkeypatch):
    """Entries of all fingerprints meet by key in one exchange; what follows reads the written, shared ones."""
    plans = []
    write = Tables.write
    monkeypatch.setattr(simhash, "ENTRIES", 100)
    monkeypatch.setattr(Tables, "write", lambda self, df, label: plans.append(df) or write(self, df, label))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = simhash.links(spark.createDataFrame([(v,) for v in (0, 1, 3, 5)], "fp long"), 4, Tables(spark))
        plans = [p._jdf.queryExecution().executedPlan().toString() for p in (*plans, edges)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    whole = [p for p in plans if "Generate posexplode" in p and "Sample" not in p]
    assert len(whole) == 1 and whole[0].count("Exchange hashpartitioning(pos") == 1


def test_every_layout_finds_every_link():
    rng = random.Random(4)
    for extra in (0, 1, 2, 4):
        parts = simhash._parts(4, extra)
        for _ in range(500):
            flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
            assert min((flips & m).bit_count() for m in parts) <= 1


def test_awkward_rows(spark, awkward):
    found = simhash.classes(awkward).collect()
    assert len(found) == awkward.count()
    blank = {r["component_id"] for r in found if r["fp"] == 0}
    assert blank == {0}
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) <= 2 and 5 not in ids and 0 in ids and None in ids
    assert simhash.classes(awkward.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(awkward.limit(0)).count() == 0


def test_one_of_each_group_stays(documents):
    text = prose(9, 300)
    other = prose(10, 300)
    kept = simhash.drop_near_duplicates(documents([other, text, text, text.upper(), prose(11, 200)]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 4]
