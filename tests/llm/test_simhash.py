import random
from collections import defaultdict

import numpy as np
from edge import documents, no_documents

from pulsetrail.llm import simhash
from pulsetrail.llm.common import table

random.seed(5)


def test_every_number_has_one_anchor_within_the_radius():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 64, 20_000, dtype="u8")
    a = simhash.Anchors().of(v)
    assert np.bitwise_count(a ^ v).max() <= 7 and (simhash.Anchors().of(a) == a).all()


def test_numbers_within_the_distance_share_an_anchor():
    for distance in (2, 4):
        anchors = simhash.Anchors(distance)
        for _ in range(300):
            x = random.getrandbits(64)
            y = x ^ sum(1 << k for k in random.sample(range(64), random.randint(0, distance)))
            assert set(anchors.near(x)[1].tolist()) & set(anchors.near(y)[1].tolist())


def groups_by_hand(fps, distance=2):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    out = defaultdict(list)
    for i in range(len(fps)):
        out[find(i)].append(i)
    return {i: g for g in out.values() for i in g}


def test_links_connect_what_brute_force_connects(spark):
    centre, fps = random.getrandbits(64), [random.getrandbits(64) for _ in range(150)]
    fps += [centre ^ sum(1 << k for k in random.sample(range(12), 2)) for _ in range(60)]      # a crowd
    chain = random.getrandbits(64)
    for _ in range(25):                                                                       # and a long chain
        chain ^= sum(1 << k for k in random.sample(range(64), 2))
        fps.append(chain)
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    for r in edges.collect():
        assert ((r["u"] ^ r["v"]) & ((1 << 64) - 1)).bit_count() <= 2
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = groups_by_hand(fps)
    for i, x in enumerate(signed):
        assert roots.get(x, x) == min(signed[j] for j in want[i])


def test_report(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    docs = docs.unionByName(documents(spark).select("doc_id", "text"))
    got = simhash.report(docs).collect()
    assert len(got) == docs.count()
    fps = [int(r["fingerprint"], 16) for r in got]
    assert sorted(fps) == sorted(simhash.fingerprint(r["text"]) & ((1 << 64) - 1) for r in docs.collect())
    want = groups_by_hand(fps)
    for i, r in enumerate(got):
        assert r["component_id"] == min((got[j]["doc_id"] for j in want[i] if got[j]["doc_id"] is not None), default=None)
    by_sql = docs.where("doc_id = 5").selectExpr("hex(xxhash64('one')) AS h").first()["h"].lower()
    assert by_sql.rjust(16, "0") in {r["fingerprint"] for r in got if r["doc_id"] == 5}      # "one" is one shingle
    assert simhash.report(no_documents(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    stays = simhash.one_each(docs)
    ids = [r["doc_id"] for r in stays.collect()]
    assert stays.columns == docs.columns
    assert ids.count(5) == 1 and 7 in ids and 8 not in ids and sum(i in (2, 3, 4) for i in ids) == 1
    assert simhash.one_each(no_documents(spark)).count() == 0
