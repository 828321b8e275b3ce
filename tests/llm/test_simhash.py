import random

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rowferry.llm.simhash import fingerprint_of, hamming_links, simhash_groups
from tests.llm.data import documents, empty


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [words] if 0 < len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def closure(links, ids):
    """The smallest id reachable from each."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
    return root


def test_hash_is_sparks(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a bé c")).alias("h")).first()
    assert row["h"] % (1 << 64) == xxh64_intdigest("a bé c".encode(), 42)


@pytest.mark.parametrize("hot", [529, 1])
def test_links_against_all_pairs(spark, hot):
    draw = random.Random(1)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        base = draw.getrandbits(64)
        prints.add(base)
        for _ in range(draw.randint(0, 6)):
            for _ in range(draw.randint(1, 4)):
                base ^= 1 << draw.randrange(64)
            prints.add(base)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    found = [tuple(r) for r in hamming_links(df, hot).collect()]
    order = sorted(signed.items(), key=lambda x: x[1])
    expected = {(a, b) for i, (p, a) in enumerate(order) for q, b in order[i + 1 :] if bin(p ^ q).count("1") <= 2}
    assert len(found) == len(set(found)) and set(found) == expected


def test_groups(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    assert prints == [fingerprint_of((r["text"] or "").encode()) % (1 << 64) for r in rows]
    pairs = [(i, j) for i, p in enumerate(prints) for j in range(i) if bin(p ^ prints[j]).count("1") <= 2]
    root = closure(pairs, range(len(rows)))
    least = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[root[i]] = min(least.get(root[i], r["doc_id"]), r["doc_id"])
    expected = sorted((str(r["doc_id"]), f"{prints[i]:016x}", str(least.get(root[i]))) for i, r in enumerate(rows))
    found = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in simhash_groups(docs).collect())
    assert found == expected
    assert simhash_groups(empty(spark)).count() == 0
