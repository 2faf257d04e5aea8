"""SuperMinHash near-duplicates against brute force."""

import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from mention_pulse.llm import common, superminhash

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2)))


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * min(len(x), len(y)) >= 85 * max(len(x), len(y)) and 100 * len(x & y) >= 85 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), c, doc_id == c))
    return sorted(out, key=repr)


def found(docs, **bands):
    got = superminhash.near_duplicates(docs, superminhash.Bands(**bands))
    return sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def group(rng, size, base, changes):
    """Copies of a text with some words of their own."""
    out = []
    for k in range(size):
        words = list(base)
        for at in rng.sample(range(len(words)), changes):
            words[at] = f"w{k}x{at}"
        out.append(" ".join(words))
    return out


def test_groups_of_the_tables(spark):
    docs = common.documents(spark, SF)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("block", [1024, 8])
def test_chains_large_bands_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(superminhash, "HOT", 16)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [None, "", " \n", "one", "ONE", "one two", "two one", "a b c", "a b C", "x " * 30000]
    base = [word() for _ in range(120)]
    texts += group(rng, 60, base, 2)  # near each other or not, by chance: borderline pairs
    texts += group(rng, 40, base, 4)
    chain = [word() for _ in range(200)]
    for step in range(12):  # each text is near the next only
        texts.append(" ".join(chain[step * 4 : step * 4 + 150]))
    licence = [word() for _ in range(100)]
    texts += [" ".join(licence + [word() for _ in range(30)]) for _ in range(30)]  # share a passage, not linked
    texts += ["same text of a few words here"] * 50
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "one"), (None, "nobody else says this"), (4, "another text of a repeated id")]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "c", "s") for i, t in rows], "doc_id long, text string, component_id string, members string")
    assert found(docs, block=block) == brute(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def by_the_book(members, positions):
    """The algorithm element by element, with its early stopping."""
    h = np.full(positions, superminhash._NONE)
    for m in members:
        order = list(range(positions))
        for j in range(positions):
            if (h >> np.uint64(56)).max() < j:  # all positions hold offers of earlier steps
                break
            value, choice = superminhash._offer(np.array([m], np.uint64), j, positions - j)
            k = j + int(choice[0])
            order[j], order[k] = order[k], order[j]
            h[order[j]] = min(h[order[j]], value[0])
    return h


@pytest.mark.parametrize("piece", [1 << 16, 40])
def test_signatures_are_the_element_wise_ones(monkeypatch, piece):
    monkeypatch.setattr(superminhash, "_PIECE", piece)
    rng = np.random.default_rng(5)
    sizes = [1, 0, 3, 40, 200, 7, 0, 90]
    members = rng.integers(0, 1 << 63, sum(sizes)).astype(np.uint64)
    at = np.append(0, np.cumsum(sizes))
    got = superminhash.signatures(members, at, 24)
    for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
        assert (got[i] == by_the_book(members[a:b], 24)).all()


def test_similarity_is_estimated():
    rng = np.random.default_rng(2)
    members = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    x, y = members[:920], members[80:]  # 840 of 1000
    at = np.array([0, 920, 1840])
    got = superminhash.signatures(np.concatenate([x, y]), at, 192)
    assert abs((got[0] == got[1]).mean() - 0.84) < 0.1


def test_sets():
    texts = ["a b c d a b c", "A B", "a", "", None, "a b c"]
    members, at = superminhash.shingle_sets(pa.array(texts))
    assert np.diff(at).tolist() == [len(brute_set(t)) for t in texts]
    assert members[at[5]] in members[: at[1]]
    packed = superminhash._unpacked(superminhash._packed(members).tobytes())
    assert ((members >> np.uint64(16)) << np.uint64(16) == packed).all()
