import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadcast.llm import simhash
from roadcast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """``prints``: id to fingerprint."""
    label = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def check(result, texts, radius=2):
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    labels = plain_components(prints, radius)
    expected = sorted((i, f"{prints[i]:016x}", labels[i]) for i in texts)
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in result) == expected


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    check(QUERIES["op5_simhash_neighbours"](spark, SF_DIR).collect(), texts)


def as_rows(linked):
    return linked.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id").collect()


def test_edge_texts(spark):
    texts = {
        1: None, 2: "", 3: " \t\n", 4: "One", 5: "one", 6: "a b c d", 7: "A  B\tC d", 8: "Ä ä Ü",
        9: "x y z", 10: "long " * 200_000, 11: "a b c d",
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    clashing = frame.withColumn("fp", F.lit(1)).withColumn("key", F.lit("k")).withColumn("node", F.lit(None).cast("int"))
    check(as_rows(simhash.linked_documents(clashing)), texts)


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.linked_documents(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, "zz")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in simhash.linked_documents(rows).collect())
    assert got == [(0, 0), (0, 3), (3, 3), (3, 3)]


@pytest.mark.parametrize("n", [40, 700])
def test_links_connect_like_all_pairs(n):
    rng = np.random.default_rng(n)
    centre = rng.integers(0, 2**63, 6, np.uint64)
    prints = centre[rng.integers(0, 6, n)]
    for _ in range(2):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    prints = np.unique(prints)
    a, b = simhash.links_in_runs(np.zeros(len(prints), np.int64), prints.reshape(-1, 1), 2, simhash.pivot_fingerprints(1))
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        assert (int(prints[i]) ^ int(prints[j])).bit_count() <= 2
        label[max(root(i), root(j))] = min(root(i), root(j))
    expected = plain_components(dict(enumerate(int(p) for p in prints)), 2)
    assert [root(i) for i in range(len(prints))] == [expected[i] for i in range(len(prints))]


def test_every_near_pair_shares_a_key():
    rng = np.random.default_rng(1)
    for _ in range(300):
        differing = rng.choice(64, 2, replace=False)
        assert any(not np.isin(choice, differing).any() for choice in simhash.block_choices(64, 2))


def test_rows_that_share_an_id_keep_classes_of_their_own(spark):
    rows = [(5, "a b c d e"), (5, "quite another text stands here"), (2, "a b c d e"), (9, "quite another text stands here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("begin", F.substring("text", 1, 1))
    got = simhash.linked_documents(docs, keep=("begin",)).collect()
    assert sorted((r["begin"], r["doc_id"], r["component_id"]) for r in got) == [("a", 2, 2), ("a", 5, 2), ("q", 5, 5), ("q", 9, 5)]


@pytest.mark.parametrize("least", [10, 1000])
def test_large_groups_are_dealt_again(spark, monkeypatch, least):
    """Thousands of near copies with different fingerprints that share the bits of a key."""
    monkeypatch.setattr(simhash, "LONG_GROUP", least)
    rng = np.random.default_rng(4)
    prints = {0}
    while len(prints) < 3000:
        near = int(rng.choice(list(prints)))
        for bit in rng.integers(0, 32, rng.integers(1, 6)):
            near ^= 1 << int(bit)
        prints.add(near)
    prints = sorted(prints)
    rows = [(p, p.to_bytes(8, "big")) for p in prints]
    classes = spark.createDataFrame(rows, "node long, fp binary").repartition(4)
    links = [(r["a"], r["b"]) for r in simhash.near_links(classes, simhash.block_choices(64, 2), 2).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    number = {p: i for i, p in enumerate(prints)}
    expected = []
    for p in prints:
        near = [p ^ 1 << i for i in range(32)] + [p ^ 1 << i ^ 1 << j for i in range(32) for j in range(i)]
        expected += [(number[p], number[o]) for o in near if o in number]
    assert label_of(len(prints), [(number[a], number[b]) for a, b in links]) == label_of(len(prints), expected)


def label_of(n, links):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    for a, b in links:
        label[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]
