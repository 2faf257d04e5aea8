"""Operators against brute force on small fixtures, with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from mention_pulse.llm import (
    chat,
    components,
    decontamination,
    lm,
    pieces,
    pii,
    quality_model,
    quality_rules,
    simhash,
    token_files,
    toxicity,
)

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "Alpha beta gamma delta epsilon zeta eta theta iota kappa",
    "alpha BETA gamma delta epsilon zeta eta theta iota kappa",
    "Grüße  aus\tKöln ▁ 日本語 😀 \x1c end",
    "line one is here\nline one is here\n\n#tag $5 <b> & more",
    " lead and trail  ",
    "the same ten words in another case are no repeat THE SAME TEN WORDS IN ANOTHER CASE ARE NO REPEAT",
    "<|endoftext|> stays text",
    "word " * 30000,
    "x" * 50000,
]


def frame(spark, texts=TEXTS):
    """Documents with repeated rows, a null doc_id and columns with clashing names."""
    rows = [(i, t, "en" if i % 3 else None, f"s{i}") for i, t in enumerate(texts)]
    rows += [rows[4], (None, "no id here at all", "en", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp string").withColumnRenamed("fp", "list")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, list string")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


# ---- quality rules ---------------------------------------------------------------------------
def brute_counts(text):
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    marked = {j for i in range(len(own) - 7) if windows[tuple(own[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked)
    )


def test_quality_counts(spark):
    got = quality_rules.quality_rules(frame(spark)).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "no id here at all" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        want = brute_counts(text)
        assert tuple(r[c] for c in quality_rules.COUNTS) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and not (r["kept"] and failed)
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_quality_keeps_usual_texts_and_rejects_shouting(spark):
    rng = np.random.default_rng(5)
    common = "the of and to in is that it".split()
    def text():
        return " ".join(str(rng.choice(common)) if rng.random() < 0.5 else "".join(rng.choice(list("aeinorst"), 6)) for _ in range(120))
    docs = [text() for _ in range(60)]
    odd = [text().upper().replace(" ", "!! ") for _ in range(2)]
    got = quality_rules.quality_rules(frame(spark, docs + odd)).filter("doc_id IS NOT NULL").collect()
    assert all(r["kept"] == (r["doc_id"] < 60) for r in got)
    kept = quality_rules.keep_good(frame(spark, docs + odd))
    assert kept.columns == ["doc_id", "text", "lang", "list"] and {r["doc_id"] for r in kept.collect()} == set(range(60))


def test_quality_judges_other_scripts(spark):
    rng = np.random.default_rng(7)
    common = "который потому человек сегодня например однако всегда вместе".split()
    def text(letters="абвгдежзиклмн", own=common):
        return " ".join(str(rng.choice(own)) if rng.random() < 0.5 else "".join(rng.choice(list(letters), 6)) for _ in range(120))
    docs = [text() for _ in range(60)]
    other_words = [text(own=["".join(rng.choice(list("опрстуфх"), 8)) for _ in range(120)]) for _ in range(2)]
    shouting = [text().upper().replace(" ", "》》 ") for _ in range(2)]
    got = quality_rules.quality_rules(frame(spark, docs + other_words + shouting).withColumn("lang", pa_lit())).filter("doc_id IS NOT NULL").collect()
    assert all(r["kept"] == (r["doc_id"] < 60) for r in got)
    assert all((r["word_distance"] > 0.5) == (r["doc_id"] >= 60) for r in got)
    assert all((r["char_distance"] > 0.3) == (r["doc_id"] >= 62) for r in got)


def test_quality_classes():
    texts = ["aé", "Я я 中𠀀", "हि ٣“\u3000", "", "😀"]
    data, starts = quality_rules.common.text_bytes(pa.array(texts))
    got = [{quality_rules.CLASSES[i]: int(n) for i, n in enumerate(row) if n} for row in quality_rules._classes(data, starts)]
    assert got == [
        {"lower": 1, "LATIN letter": 1},
        {"white": 2, "CYRILLIC letter": 1, "CYRILLIC upper": 1, "CJK letter": 2},
        {"white": 1, "digit": 1, "stop": 1, "other space": 1, "DEVANAGARI letter": 1, "DEVANAGARI sign": 1},
        {},
        {"mark": 1},
    ]


def test_distance():
    p = np.array([[0.5, 0.5, 0.0], [0.2, 0.3, 0.5]])
    q = np.array([0.2, 0.3, 0.5])
    m = (p[0] + q) / 2
    want = sum(a * math.log2(a / c) for a, c in zip(p[0], m) if a) / 2 + sum(b * math.log2(b / c) for b, c in zip(q, m)) / 2
    assert quality_rules.distance(p, q) == pytest.approx([math.sqrt(want), 0.0], abs=1e-9)


# ---- SimHash ---------------------------------------------------------------------------------
def brute_components(values):
    values = sorted(set(values))
    label = {v: v for v in values}
    moved = True
    while moved:
        moved = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 4 and label[b] < label[a]:
                    label[a], moved = label[b], True
    return label


@pytest.mark.parametrize("max_list", [4096, 5])
def test_simhash_links(spark, max_list):
    rng = np.random.default_rng(2)
    values = [0]
    for base in rng.integers(0, 1 << 63, 5).tolist():
        for _ in range(40):
            values.append(base ^ sum(1 << int(b) for b in set(rng.integers(0, 63, rng.integers(0, 7)).tolist())))
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), max_list)
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert {v: got.get(v, v) for v in values} == brute_components(values)


def test_simhash_documents(spark):
    import xxhash

    def brute(text):
        own = words(text)
        if not own:
            return 0
        shingles = [own[i : i + 4] for i in range(len(own) - 3)] or [own]
        h = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    got = simhash.near_duplicates(frame(spark)).collect()
    assert len(got) == len(TEXTS) + 2
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(r["fingerprint"] == f"{brute(TEXTS[i]):016x}" for i, r in by_id.items())
    assert by_id[0]["component_id"] == by_id[1]["component_id"] == by_id[2]["component_id"] == 0
    assert by_id[5]["component_id"] == 4
    kept = simhash.keep_one(frame(spark))
    assert kept.columns == ["doc_id", "text", "lang", "list"]
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [0, *[i for i in range(3, len(TEXTS)) if i != 5]]
    assert simhash.near_duplicates(empty(spark)).count() == 0


# ---- token files -----------------------------------------------------------------------------
@pytest.mark.parametrize("high", [1, 100, 50256, 1 << 40, (1 << 64) - 1])
def test_packing(high):
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 3000):
        ids = rng.integers(0, high, n, dtype=np.uint64, endpoint=True)
        ids[rng.random(n) < 0.3] = 0
        packed, first = token_files.pack(ids)
        assert (token_files.unpack(packed, first, n) == ids).all()


def test_token_files(spark):
    from tokenizers import Tokenizer

    from mention_pulse.llm.common import shared_folder

    library = Tokenizer.from_file(BYTES)
    files = token_files.write_files(frame(spark), shared_folder(spark, "t"), BYTES)
    got = sorted(token_files.read_files(spark, files).collect(), key=lambda r: r["start"])
    texts = {i: t or "" for i, t in enumerate(TEXTS)} | {None: "no id here at all"}
    start = 0
    assert [r["doc_id"] for r in got] == sorted([None, *range(len(TEXTS)), 4], key=lambda x: -1 if x is None else x)
    for r in got:
        ids = [*library.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0]
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    assert token_files.read_files(spark, token_files.write_files(empty(spark), shared_folder(spark, "t"), BYTES)).count() == 0


def test_parts_encode_as_whole_texts():
    import random

    own = token_files.encoder(BYTES)
    rng = random.Random(4)
    letters = list("abTH  \n\t é日😀1 .,'!-") + ["'s", "\xa0", "\x85", "<|endoftext|>", "   "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 20))) for _ in range(5000)]
    want = [x.ids for x in own.library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, np.uint32).tolist() for x in own.encode(texts)] == want


# ---- pieces ----------------------------------------------------------------------------------
def test_pieces_are_the_library_s(spark):
    import random

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own = pieces.model(PIECES)
    rng = random.Random(4)
    letters = list("abcdeth  \n\t▁é日😀1 .,'") + ["the", " in", "    ", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    for text in [*texts, *["a" + " " * n + "x" for n in range(40)], *(t or "" for t in TEXTS)]:
        ids = [*library.encode(text), 2]
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids)
    got = {r["doc_id"]: r for r in pieces.encode_digests(frame(spark), PIECES).collect()}
    for i, text in enumerate(TEXTS):
        ids = [*library.encode(text or ""), 2]
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    full = {r["doc_id"]: r for r in pieces.encode(frame(spark), PIECES).collect()}
    assert full[6]["ids"] == [*library.encode(TEXTS[6]), 2] and full[6]["decoded"] == library.decode(full[6]["ids"])
    assert pieces.encode_digests(empty(spark), PIECES).count() == 0


# ---- personal data ---------------------------------------------------------------------------
def brute_base(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(a, b, pii.KINDS[k]) for a, k, b in sorted(found)]


def test_base_spans():
    import random

    rng = random.Random(9)
    bits = ["a", "b.", "@", "@x.y", "é", " ", "+1 (212) 555-0100", "4111 1111 1111 1111", "10.0.0.1", "300.1.1.1", "-", ".", "7", "+", "0001.2.3.4", "@@"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == brute_base(text), text


def test_contexts_discover_identifiers(spark):
    seeds = [f"please reach me via handle u{i}x@mail.example.com today" for i in range(8)]
    hidden = ["please reach me via handle kit42[at]example today", "the number 12345 is via nothing", None, ""]
    docs = frame(spark, seeds + hidden)
    got = {r["doc_id"]: r for r in pii.find_digests(docs).collect()}
    at = hidden[0].index("kit42")
    assert got[8]["spans"] == f"context:{at}:{at + len('kit42[at]example')}"
    assert got[9]["spans"] == "" and got[10]["spans"] == "" and got[8]["n_email"] == 0
    assert got[0]["n_email"] == 1 and got[0]["base_sha256"] == hashlib.sha256(got[0]["spans"].encode()).hexdigest()
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs).collect()}
    assert masked[8] == "please reach me via handle [context] today" and masked[10] is None
    assert masked[0] == "please reach me via handle [email] today"
    assert pii.find_digests(empty(spark)).count() == 0


# ---- chat ------------------------------------------------------------------------------------
def test_personal_data_of_odd_rows(spark):
    digits = "7" * 1_000_000
    assert [s for s in pii.base_spans(f"{digits} 1.2.3.4.5.6.7.8 01.2.3.256") if s[2] == "ip"] == [
        (1000001, 1000008, "ip"), (1000009, 1000016, "ip")
    ]
    long = "w" * 5000  # a word before seeds, longer than any window
    texts = [digits, None, "", *[f"{long} user{i}@mail.org and {long} hidden-{i}" for i in range(8)], "tel +49 (30) 1234567"]
    rows = [(i, t, f"own {i}", [i]) for i, t in enumerate(texts)] + [(3, texts[3], "own 3", [3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind array<int>")
    got = pii.mask(docs).collect()
    assert len(got) == len(rows) and {r["doc_id"]: r["spans"] for r in got} == {r[0]: r[2] for r in rows}
    by_id = {r["doc_id"]: r["text"] for r in got}
    assert by_id[0] == digits and by_id[1] is None and by_id[2] == ""
    # a pattern counted through the long word: its other places are found
    assert by_id[3] == f"{long} [email] and {long} [context]" and by_id[11] == "tel [phone]"
    assert pii.mask(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    text = "some words that make up a text of their own and go on for a while so that copies are near"
    other = "entirely different content under the very same number with no word in common at all here"
    rows = [(4, text, "a"), (7, text, "b"), (4, other, "c"), (4, text, "a"), (9, other, "d"), (None, text, "e"), (2, "alone here", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, content string")
    got = sorted(map(tuple, simhash.keep_one(docs).collect()), key=repr)
    assert got == sorted([(4, text, "a"), (4, other, "c"), (None, text, "e"), (2, "alone here", "f")], key=repr)


def test_chat_reads_back(spark):
    texts = ["\\### Assistant: </turn> ok", "", "### x </turn>\n\\", "plain: text", "#### ### </turn></turn>", "é" * 3000]
    rows = [(c, t, r, texts[(c + t) % 6]) for c in (-7, 0, 1) for t, r in enumerate(["system", "user", "assistant", "user", "assistant"])]
    rows += [(None, None, None, None), (5, 1, "assistant", "b"), (5, 1, "assistant", "a"), (5, None, "a:b\\", "first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("output", pa_lit())
    got = {r["conv_id"]: r for r in chat.format_digests(turns).collect()}
    for conv in (-7, 0, 1, None, 5):
        own = sorted(((t is not None, t, r or "", x or "") for c, t, r, x in rows if c == conv))
        text = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv]["formatted_chars"] == len(chat.marked_turns([(r, x) for _, _, r, x in own]))
    whole = sorted((r for r in chat.format_turns(turns).collect() if r["conv_id"] == 0), key=lambda r: r["begin"])
    assert "".join(r["output"] for r in whole) == chat.marked_turns([(r, x) for c, _, r, x in rows if c == 0])
    assert chat.format_digests(turns.limit(0)).count() == 0


def pa_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_chat_detects_rewriting():
    forgets = chat.Renderer(lambda turns: "".join(x for _, x in turns[-1:]))
    forgets.add("user", "one")
    assert forgets.add("user", "two") is None and forgets.rewrites
    keeps = chat.Renderer(chat.marked_turns)
    piece = keeps.add("assistant", "a</turn>b")
    assert chat.unescape(piece.output[piece.begin : piece.end]) == "a</turn>b"


def test_chat_renders_the_whole_conversation(spark):
    def last_five(turns):
        return "".join(f"<{x}>" for _, x in turns[-5:])

    def numbered(turns):
        return "BOS " + "".join(f"{i} {r}: {x}\n" for i, (r, x) in enumerate(turns))

    def user_first(turns):
        if turns[0][0] != "user" or any(a == b for (a, _), (b, _) in zip(turns, turns[1:])):
            raise ValueError("roles must alternate, user first")
        return "".join(f"{r}: {x}\n" for r, x in turns)

    rows = [(c, t, "assistant" if t % 2 else "user", f"text {t}") for c, n in ((1, 9), (2, 5), (3, 6)) for t in range(n)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = {c: [(r, x) for k, _, r, x in rows if k == c] for c in (1, 2, 3)}
    for template in (numbered, user_first):
        got = chat.format_turns(turns, template).orderBy("conv_id", "begin").collect()
        assert len(got) == len(rows) and not any(r["rewrites"] for r in got)
        for c in own:
            mine = [r for r in got if r["conv_id"] == c]
            whole = "".join(r["output"] for r in mine)
            assert whole == template(own[c])
            assert [whole[r["text_begin"] : r["text_end"]] for r in mine] == [x for _, x in own[c]]
    got = chat.format_turns(turns, last_five).collect()
    assert len(got) == len(rows) and all(r["rewrites"] == (r["conv_id"] != 2) for r in got)
    assert all((r["output"] is None) == r["rewrites"] == (r["begin"] is None) for r in got)
    local = chat.format_turns(turns, lambda turns: "".join(f"{r}> {x}\n" for r, x in turns), window=0)
    assert "".join(r["output"] for r in local.filter("conv_id = 3").orderBy("begin").collect()).startswith("user> text 0\nassistant> ")


# ---- language model --------------------------------------------------------------------------
def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, universe in ((1, 10), (1000, 1 << 40), (5000, 300), (1, 1 << 62), (20000, 1 << 33)):
        values = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
        arrays, shift = lm.EliasFano.build(values, universe, "x")
        own = lm.EliasFano(arrays, "x", shift, n)
        assert (own.at(np.arange(n)) == values.astype(np.int64)).all()
        for first, end in ((0, n), (n // 3, n // 2), (n - 1, n), (n, n)):
            assert (own.between(first, end) == values[first:end].astype(np.int64)).all()
        asked = np.concatenate([values, rng.integers(0, universe, 500).astype(np.uint64)])
        place, equal = own.successor(asked)
        assert (place == np.searchsorted(values, asked)).all() and (equal == np.isin(asked, values)).all()


@pytest.mark.parametrize("shard_tokens", [1_000_000, 50])
def test_language_model(spark, shard_tokens):
    rng = np.random.default_rng(8)
    vocabulary = [f"W{i}" for i in range(40)]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 60)), p=np.arange(40, 0, -1) / 820)) for _ in range(30)]
    texts += [None, "", "unseen words W1 only here", "W0 " * 400]
    docs = frame(spark, texts)
    own = docs.withColumn("held_out", lm.fold(7) == 2)
    model = lm.train(own.filter("NOT held_out"), 3, shard_tokens)
    got = lm.score(own, model, ("held_out",)).collect()
    all_texts = {i: t for i, t in enumerate(texts)} | {None: "no id here at all"}
    counts = [Counter(), Counter(), Counter()]
    for i in [*range(len(texts)), 4, None]:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            w = [*words(all_texts[i]), None]
            s = [None, *w]
            counts[0].update(w)
            counts[1].update(zip(s, s[1:]))
            counts[2].update(zip(s, s[1:], s[2:]))
    n, v = sum(counts[0].values()), len(counts[0])
    behind = [Counter(), Counter(), Counter()]
    distinct = [Counter(), Counter(), Counter()]
    discount = [0.0] * 3
    for k in (1, 2):
        for key, c in counts[k].items():
            behind[k][key[:-1]] += c
            distinct[k][key[:-1]] += 1
        one, two = (sum(c == x for c in counts[k].values()) for x in (1, 2))
        discount[k] = min(0.95, max(0.05, one / (one + 2 * two)))
    assert len(got) == len(texts) + 2
    for r in got:
        w = [*words(all_texts[r["doc_id"]]), None]
        past = [None, *w]
        base = score = 0.0
        for i, x in enumerate(w):
            p = (counts[0][x] + 1) / (n + v + 1)
            base += math.log10(p)
            for k, context in ((1, past[i : i + 1]), (2, past[i - 1 : i + 1] if i else None)):
                context = tuple(context) if context is not None else None
                if context is not None and behind[k][context]:
                    c = counts[k][(*context, x)]
                    p = (max(0, c - discount[k]) + discount[k] * distinct[k][context] * p) / behind[k][context]
            score += math.log10(p)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[0][x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, abs=3e-4 * len(w))
    assert lm.held_out_scores(empty(spark)).count() == 0


def test_children_by_low_parts():
    rng = np.random.default_rng(3)
    for n_words, contexts, most in ((1, 5, 1), (40, 30, 40), (300, 50, 200), (70_000, 200, 900), (1 << 34, 40, 30)):
        sizes = np.minimum(rng.integers(1, most + 1, contexts), n_words)
        sizes[-1] = min(most, n_words)
        words_of = [np.sort(rng.choice(n_words, k, replace=False) if n_words < 1 << 20 else np.unique(rng.integers(0, n_words, k))) for k in sizes]
        begins = np.append(0, np.cumsum([len(w) for w in words_of]))
        keys = np.concatenate([c * n_words + w for c, w in enumerate(words_of)]).astype(np.uint64)
        pointers, pointer_shift = lm.EliasFano.build(begins, len(keys), "p")
        first, end = lm.EliasFano(pointers, "p", pointer_shift, contexts + 1).pair(np.arange(contexts))
        assert (first == begins[:-1]).all() and (end == begins[1:]).all()
        shifts = {lm.EliasFano.build(keys, contexts * n_words, "x")[1], *(s for s in (8, 16) if n_words < 1 << 20)}
        for shift in shifts:  # a universe that asks for this shift
            arrays, own = lm.EliasFano.build(keys, max(contexts * n_words, len(keys) << shift), "x")
            children = lm.EliasFano(arrays, "x", own, len(keys))
            asked = np.sort(np.concatenate([keys, rng.integers(0, contexts * n_words, 2000).astype(np.uint64)]))
            local = (asked // np.uint64(n_words)).astype(np.int64)
            base = local.astype(np.uint64) * np.uint64(n_words)
            at, there = children.child(base, asked - base, n_words, begins[local], begins[local + 1])
            assert (there == np.isin(asked, keys)).all() and (at[there] == np.searchsorted(keys, asked[there])).all()


def test_ngrams_in_order():
    rng = np.random.default_rng(5)
    bounds = [(0, 0), (3, 0), (3, 4), (3, 9), (7, 0), (20, 0)]
    none = np.zeros(len(bounds), dtype=np.int64)
    shards = lm.Shards(*(np.array(x) for x in zip(*bounds)), none, none, none[:0], none[:0])
    for n_words, most in ((12, 25), (12, 1 << 40), (1 << 40, 1 << 40)):  # short, long and no common keys
        context = np.append(rng.integers(0, 25, 500), rng.integers(0, most, 50))
        word = rng.integers(-1, 12, 550)
        order, first = lm._in_order(context, word, n_words)
        pairs = sorted(zip(context.tolist(), word.tolist()))
        assert list(zip(context[order].tolist(), word[order].tolist())) == pairs
        assert first.tolist() == [i == 0 or pairs[i] != pairs[i - 1] for i in range(len(pairs))]
        begins = shards.begins(context[order], word[order])
        for i, (c, w) in enumerate(pairs):
            k = max(k for k, bound in enumerate(bounds) if bound <= (c, max(w, 0)))
            assert begins[k] <= i < begins[k + 1]
        tallied = lm._tallied(context, np.maximum(word, 0), n_words)
        counts = Counter((c, max(w, 0)) for c, w in pairs)
        assert list(zip(*(x.tolist() for x in tallied))) == [(*pair, counts[pair]) for pair in sorted(counts)]


def test_look_ups_select_little(spark, monkeypatch):
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.2, 400) % 3000) for _ in range(50)]
    model = lm.train(frame(spark, texts), 3)
    selected, select = [], lm._select
    monkeypatch.setattr(lm, "_select", lambda words, before, k, ones: selected.append(len(k)) or select(words, before, k, ones))
    tokens = lm.Tokens.of(pa.array(texts))
    lm._scores(model, tokens)
    # selections are for distinct words and contexts, not twice for each n-gram besides
    assert sum(selected) < 1.6 * len(tokens.h)


# ---- decontamination -------------------------------------------------------------------------
def test_leaks(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(3000)]

    def text(n):
        return " ".join(rng.choice(vocabulary, n))

    items = [f"{text(30)}. {text(8)}." for _ in range(10)] + [None, "", "too short"]
    changed = items[3].split()
    for i in range(2, 28, 4):
        changed[i] = "other"
    docs = [text(200) for _ in range(30)]
    docs += [f"{text(45)} {items[0].upper()} {text(70)}", f"{text(5)} {' '.join(changed)} {text(90)}", items[7], None, "", text(4000)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("cosine", pa_lit())
    got = decontamination.leaks(frame(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(30, 0), (31, 3), (32, 7)}
    assert next(r for r in got if r["doc_id"] == 30)["lcs_share"] == 1.0
    kept = decontamination.without_leaks(frame(spark, docs), bench)
    assert {r["doc_id"] for r in kept.collect()} == {None, *range(30), 33, 34, 35} and kept.columns == ["doc_id", "text", "lang", "list"]
    assert decontamination.leaks(frame(spark, docs), bench.limit(0)).count() == 0
    assert decontamination.leaks(empty(spark), bench).count() == 0


def test_leaks_of_short_items(spark):
    rng = np.random.default_rng(9)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(3000)]

    def text(n):
        return " ".join(rng.choice(vocabulary, n))

    items = [text(n) for n in (5, 6, 8, 10, 12, 15, 20) for _ in range(12)]

    def around(i, n):
        """A rare word of the benchmark, said again and again: it turns a window away from a short item."""
        return " ".join([items[(i + 12) % len(items)].split()[0]] * n)

    docs = [f"{around(i, 40)} {item} {around(i, 40)}" for i, item in enumerate(items)]
    docs += [items[0], f"{items[1]} {text(60)}"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in decontamination.leaks(rows, bench).collect()}
    want = [(i, i) for i in range(len(items))] + [(len(items), 0), (len(items) + 1, 1)]
    assert [pair for pair in want if got.get(pair) != 1.0] == []
    assert {pair for pair, share in got.items() if share == 1.0} == set(want)
    # nothing is left of the rows that leak
    assert decontamination.without_leaks(rows, bench).count() == 0


def test_near_windows_by_bands():
    rng = np.random.default_rng(5)
    how = decontamination.Search()
    for n, m in ((0, 5), (1, 1), (400, 150)):
        latent = rng.standard_normal((m, 6)).astype(np.float32)
        latent /= np.linalg.norm(latent, axis=1)[:, None]
        length = rng.uniform(1, 9, m).astype(np.float32)
        vectors = (rng.standard_normal((n, 6)) * rng.choice([0, 0.3, 3], (n, 1))).astype(np.float32)
        cosine = np.full(m, how.cosine, dtype=np.float32)
        index = decontamination.Index(how, [], [], np.zeros(0, np.uint64), latent, latent, length, length)
        index.cosine = cosine
        windows, own = np.arange(0, n, 2), np.flatnonzero(rng.random(m) < 0.9)
        norm = np.sqrt((vectors[windows] ** 2).sum(axis=1))
        near = vectors[windows].astype(float) @ latent[own].T
        expected = np.flatnonzero(near >= np.maximum(cosine[own] * norm[:, None], how.contained * length[own]))
        assert sorted(index._near(vectors, windows, norm, own).tolist()) == expected.tolist()
    term, block = np.array([0, 1, 1, 2, 0]), np.array([1, 1, 1, 3, 3])
    index.terms = np.arange(6, dtype=np.float32).reshape(3, 2)
    assert index._block_sums(term, block, 5).tolist() == [[0, 0], [4, 7], [0, 0], [4, 6], [0, 0]]
    assert index._block_sums(term[:0], block[:0], 2).tolist() == [[0, 0], [0, 0]]


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 40)).tolist(), rng.integers(0, 5, rng.integers(0, 60)).tolist()
        best = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(best[j] + 1 if x == y else max(best[j + 1], row[-1]))
            best = row
        masks = decontamination._masks(np.array(a))
        assert decontamination.common_subsequence(masks, len(a), b) == best[-1]


# ---- classifiers -----------------------------------------------------------------------------
@pytest.mark.parametrize("module, label, bad", [(toxicity, "toxic", "you zorgon fool"), (quality_model, "quality", "!!! %%% LOUD")])
def test_classifiers(spark, module, label, bad):
    rng = np.random.default_rng(6)
    def text(i):
        own = ["".join(rng.choice(list("abcdefg"), 4)) for _ in range(40)]
        return " ".join([*own, *([bad] * 3 if i % 2 else [])])
    texts = [text(i) for i in range(400)] + [None, "", text(1)]
    labels = [(i, i % 2) for i in range(400)] + [(None, 1), (5, None), (7, 1)]
    table = spark.createDataFrame(labels, f"doc_id long, {label} long")
    got = module.scores(frame(spark, texts), table).collect()
    assert len(got) == len(texts) + 2 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert held and np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.95
    none = module.scores(frame(spark, texts[:20]), table.limit(0)).collect()
    assert len(none) == 22 and {r["score"] for r in none} == {0.0}
    assert module.scores(empty(spark), table).count() == 0


def test_random_index_buckets():
    got, at = quality_model.buckets(pa.array(["The the THE!!", None, "", "a1"]))
    assert np.diff(at).tolist() == [4, 0, 0, 2] and len(set(got[:3].tolist())) == 3
