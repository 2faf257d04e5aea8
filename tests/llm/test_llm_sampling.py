"""Importance resampling and collocations against brute force."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from mention_pulse.llm import collocations, common, importance

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# ---- importance resampling ---------------------------------------------------------------------
def features(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    return len(words), [zlib.crc32(b" ".join(words[i : i + n])) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_resample(docs, target):
    """Sorted rows of (doc_id, n_features, weight, score, rank)."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    whole_s, whole_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * whole_s / ((s[b] + 1) * whole_t))) for b in range(10000)]
    out, wide = [], []
    for doc_id, text in docs:
        n, own = features(text)
        weight = sum(gain[b] for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None])
        if n >= 20:
            wide.append(out[-1])
    wide.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1], -r[2]))
    for i in range(5 * len(wide) // 100):
        wide[i][4] = i + 1
    return sorted(map(tuple, out), key=repr)


def resampled(spark, docs, target):
    return sorted(map(tuple, importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_resampling_of_the_tables(spark):
    docs, target = common.documents(spark, SF), common.documents(spark, SF, "benchmark")
    want = brute_resample([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert resampled(spark, docs, target) == want and any(r[4] for r in want)


def test_resampling_of_odd_rows(spark):
    rows = [(i, f"word{i % 7} a-b Ünï 日本 " * (4 + i % 5), "s") for i in range(120)]
    rows += [(5, rows[5][1], "twice")] * 60 + [(None, "no id at all " * 9, "s"), (200, None, "s"), (201, "", "s"), (202, "Tiny", "s")]
    rows += [(203, "x" * 300 + " " + "y " * 40000, "s")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, score string")
    target = spark.createDataFrame([("word3 a b", 1.0), (None, 2.0), ("", 3.0)], "text string, weight double")
    want = brute_resample([r[:2] for r in rows], ["word3 a b", None, ""])
    assert resampled(spark, docs, target) == want
    nothing = docs.limit(0)
    assert resampled(spark, nothing, target) == []
    assert resampled(spark, docs, target.limit(0)) == brute_resample([r[:2] for r in rows], [])


def test_checksums_of_runs():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 2, 3, 8, 63, 64, 65, 200, 5000)]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    begin = end - [len(w) for w in words]
    sums = importance.word_sums(data, begin, end)
    assert sums.tolist() == [zlib.crc32(w) for w in words]
    joined = importance.appended(sums[:-1], (end - begin)[1:]) ^ sums[1:]
    assert joined.tolist() == [zlib.crc32(a + b) for a, b in zip(words, words[1:])]


@pytest.mark.parametrize("pivots", [1, 3])
def test_quickselect_finds_every_place(spark, pivots):
    rows = [(i % 9 or None, 1, i % 4, (i * 7) % 11) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long")
    keys = sorted(((r[3], r[0], r[1], r[2]) for r in rows), key=importance._order)
    for k in (1, 2, 30, 59, 60):
        assert importance.quickselect(frame, k, pivots) == keys[k - 1]
    assert importance.quickselect(frame, 0, pivots) is None and importance.quickselect(frame, 61, pivots) is None


# ---- collocations ------------------------------------------------------------------------------
def brute_collocations(docs, min_count, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            words = re.findall(rb"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in (1, 2, 3, 4):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        around = Counter()
        for p, a in often.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    around[p[i : i + n]] = max(around[p[i : i + n]], a)
        rows = []
        for p, a in often.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, b" ".join(p), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def mined(docs, **rules):
    got = collocations.collocations(docs, collocations.Mining(**rules))
    return sorted(map(tuple, got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.mark.parametrize(("min_count", "top", "burst", "held"), [(30, 2000, 4096, 1 << 19), (3, 40, 8, 300)])
def test_collocations_of_the_tables(spark, min_count, top, burst, held):
    docs = common.documents(spark, SF)
    want = brute_collocations([(r["lang"], r["text"]) for r in docs.collect()], min_count, top)
    assert want and mined(docs, min_count=min_count, top=top, burst=burst, held=held) == want


def test_collocations_of_odd_rows(spark):
    texts = ["New York city, new york CITY. new york; ny", None, "", " .,; ", "日本 語 日本 語 日本 語", "ab\tab ab ab ab", "one", "x " * 20000]
    rows = [(i % 3 or None, t, lang, "k") for i, t in enumerate(texts) for lang in ("en", None, "und", "")]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string, lang string, key string").withColumnRenamed("key", "size")
    want = brute_collocations([(r[2], r[1]) for r in rows * 2], 4, 2000)
    assert want and mined(docs, min_count=4) == want
    assert mined(docs.limit(0)) == []


def test_tries_count_and_spill_whole_subtrees():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 12, (5000, 3)).astype(np.uint64)
    ids[:2000, 0] = 3  # a hot first word
    trie = collocations.Trie(3, burst=4)
    got = Counter()
    for at in range(0, len(ids), 700):
        trie.add(ids[at : at + 700])
        assert trie.entries == sum(sum(map(len, n)) if isinstance(n, list) else len(n) for n in trie.root.values())
        heads = set(trie.root)
        for keys, n in trie.spill(trie.entries // 2):
            assert set(keys[:, 0].tolist()) == heads - set(trie.root)
            for k, c in zip(map(tuple, keys.tolist()), n.tolist()):
                got[k] += c
    for keys, n in trie.spill(0):
        for k, c in zip(map(tuple, keys.tolist()), n.tolist()):
            got[k] += c
    assert isinstance(got, Counter) and got == Counter(map(tuple, ids.tolist())) and trie.entries == 0
