"""SentencePiece encoding and decoding by a prefix table.

For every prefix of a text the last token of that prefix's encoding is unique. An automaton over all
pieces gives the tokens that end at a place; the one whose pair with the last token of the prefix
before it survives merging unchanged is the prefix's last token. Ids are then read backwards from the
end. A pair is tested by undoing, latest first, the merges along its seam: had the two symbols that
touched at some moment formed a piece before the next of those merges, the pair would not stand.

Texts are cut before each space that follows another character, since no piece spans such a place
(checked when the model is read), and what a cut-out part encodes to is kept for later texts, in two
tables of bounded size: when the newer is full it becomes the older, so parts in use stay. Pieces made of spaces only share one score, the lowest: they join what the
others leave over, from the left.

Defined results: a null or empty text has the end id only and decodes to an empty text. Characters
without a piece become byte ids. A literal U+2581 counts as a space, as in the library. Rows come back
one for one; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm import common

SPACE = "▁"
KEPT_PARTS = 1 << 16
KEPT_PAIRS = 1 << 18
_RUN = re.compile(f"{SPACE}+[^{SPACE}]*")


class PieceModel:
    """A SentencePiece BPE model; merges of any two neighbours that form a piece, best score first."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.end = model.eos_id()
        odd = [i for i in range(size) if model.is_unused(i)]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        own = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        runs = {self.names[i]: i for i in own if len(self.names[i]) > 1 and not self.names[i].strip(SPACE)}
        score = {i: model.get_score(i) for i in own}
        self.ids = {self.names[i]: i for i in own if self.names[i] not in runs}
        self.run_ids = {len(k): i for k, i in runs.items()}
        crossing = [k for k in self.ids if SPACE in k[1:]]
        low = {score[i] for i in runs.values()}
        merged = [score[i] for k, i in self.ids.items() if len(k) > 1]
        apart = len(set(merged)) == len(merged) and (not low or (len(low) == 1 and max(low) < min(merged)))
        self.run_ids[1] = self.ids.get(SPACE, -1)
        self.longest = max(self.run_ids)
        blocks = [self._short_run(n * self.longest) == [self.longest] * n for n in (1, 2, 3)]
        if odd or crossing or not apart or len(self.bytes) != 256 or self.run_ids[1] < 0 or not all(blocks):
            raise ValueError("the model has pieces this method does not cover")
        order = sorted((i for k, i in self.ids.items() if len(k) > 1), key=lambda i: -score[i])
        self.time = {i: t for t, i in enumerate(order)}
        for k, i in self.ids.items():
            if len(k) == 1:
                self.time[i] = -1
        # ids by piece and the two symbols each piece is made of, for all that merging can reach
        self.halves: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for k, i in self.ids.items():
            if len(k) == 1:
                self.automaton.add_word(k, (i, 1))
        for i in order:
            if made := self._made_of(self.names[i]):
                self.halves[i] = made
                self.automaton.add_word(self.names[i], (i, len(self.names[i])))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.unlike: dict[str, str] = {}

    def _made_of(self, piece: str) -> tuple[int, int] | None:
        """The last merge that makes the piece, None if merging its characters ends otherwise."""
        symbols, made = list(piece), None
        if not all(c in self.ids for c in symbols):
            return None
        while len(symbols) > 1:
            best, at = None, -1
            for j in range(len(symbols) - 1):
                t = self.ids.get(symbols[j] + symbols[j + 1])
                if t is not None and (best is None or self.time[t] < best):
                    best, at = self.time[t], j
            if best is None:
                return None
            made = self.ids[symbols[at]], self.ids[symbols[at + 1]]
            if any(self.time[x] > best for x in made):
                raise ValueError("a piece is older than a part of it")
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return made

    def _stands(self, left: int, right: int) -> bool:
        """Whether encoding the two tokens' text gives just these two."""
        names, time, ids = self.names, self.time, self.ids
        limit = len(names)  # a merge over the seam at this time or later would have come too late
        while True:
            over = ids.get(names[left] + names[right])
            if over is not None and time[over] < limit:
                return False
            a, b = time[left], time[right]
            if a < 0 and b < 0:
                return True
            if a > b:  # of equal merges the left one comes first
                limit, left = a, self.halves[left][1]
            else:
                limit, right = b + 1, self.halves[right][0]

    def _tokens(self, part: str) -> list[int]:
        """Ids of a part without a run of spaces, recovered backwards from the table."""
        n = len(part)
        last, size = [-1] * (n + 1), [1] * (n + 1)
        pairs, width = self.pairs, len(self.names)
        for at, (token, length) in self.automaton.iter(part):
            if last[at + 1] >= 0:
                continue
            before = last[at + 1 - length]
            if before >= 0:
                key = before * width + token
                stands = pairs.get(key)
                if stands is None:
                    if len(pairs) >= KEPT_PAIRS:
                        pairs.clear()
                    stands = pairs[key] = self._stands(before, token)
                if not stands:
                    continue
            last[at + 1], size[at + 1] = token, length
        out: list[int] = []
        while n:
            if last[n] < 0:  # a character without a piece
                out.extend(self.bytes[b] for b in reversed(part[n - 1].encode("utf-8", "replace")))
            else:
                out.append(last[n])
            n -= size[n]
        return out[::-1]

    def _short_run(self, n: int) -> list[int]:
        """Lengths that n single spaces are joined to, the leftmost pair first."""
        lengths, at = [1] * n, 0
        while at < len(lengths) - 1:
            if lengths[at] + lengths[at + 1] in self.run_ids:
                lengths[at : at + 2] = [lengths[at] + lengths[at + 1]]
                at = max(0, at - 1)
            else:
                at += 1
        return lengths

    def _run(self, n: int) -> list[int]:
        """Ids of n spaces that no other piece took."""
        whole, rest = divmod(n, self.longest)
        return [self.run_ids[self.longest]] * whole + [self.run_ids[x] for x in self._short_run(rest)]

    def _part_ids(self, part: str) -> list[int]:
        """Ids of spaces and what follows them."""
        spaces = len(part) - len(part.lstrip(SPACE))
        if spaces == 1:
            return self._tokens(part)
        if spaces == len(part):
            return self._run(spaces)
        ids = self._tokens(part[spaces - 1 :])
        return self._run(spaces) + ids[1:] if ids[0] == self.ids[SPACE] else self._run(spaces - 1) + ids

    def _text_parts(self, text: str) -> list[str]:
        """The text with a space before it, cut before spaces; each part without its single first space."""
        if SPACE not in text:
            parts = text.split(" ")
            if all(parts):
                return parts
        return [x[1:] for x in _RUN.findall(SPACE + text.replace(" ", SPACE))]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, then the end id."""
        if not text:
            return [self.end]
        return [i for part in self._text_parts(text) for i in self._part_ids(SPACE + part)] + [self.end]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; control ids have none, and the one space put before the text goes."""
        return self._decoded(ids)[1:].decode("utf-8", "replace")

    def _decoded(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, ids))

    @property
    def spelled(self) -> list[bytes]:
        if not hasattr(self, "_spelled"):
            self._spelled = [name.replace(SPACE, " ").encode() for name in self.names]
            for value, i in self.bytes.items():
                self._spelled[i] = bytes([value])
            own = {*self.ids.values(), *self.run_ids.values(), *self.bytes.values()}
            for i in range(len(self.names)):
                if i not in own:
                    self._spelled[i] = b""
        return self._spelled

    def written(self, text: str | None) -> tuple[int, bytes, bytes]:
        """How many ids a text has, its ids as decimals with a space between, and what they decode to."""
        end = str(self.end).encode()
        if not text:
            return 1, end, b""
        if len(self.parts) >= KEPT_PARTS:
            self.older, self.parts = self.parts, {}
        if len(self.unlike) >= KEPT_PARTS:  # what these decode to goes with all kept parts
            self.older, self.parts, self.unlike = {}, {}, {}
        parts = self._text_parts(text)
        found = list(map(self.parts.get, parts))
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    found[i] = self.parts.get(parts[i]) or self._keep(parts[i])
        decimals = b" ".join((*found, end))
        if self.unlike:
            parts = [self.unlike.get(x, x) for x in parts]
        return decimals.count(b" ") + 1, decimals, " ".join(parts).encode("utf-8", "replace")

    def _keep(self, part: str) -> bytes:
        """Encode a part and decode it again; what it decodes to is kept only where it is another text."""
        if part in self.older:
            decimals = self.parts[part] = self.older[part]
            return decimals
        ids = self._part_ids(SPACE + part)
        decoded = self._decoded(ids)[1:].decode("utf-8", "replace")
        if decoded != part:
            self.unlike[part] = decoded
        decimals = self.parts[part] = " ".join(map(str, ids)).encode()
        return decimals


@cache
def model(path: str) -> PieceModel:
    """The model of a file, read once in each process."""
    return PieceModel(path)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch["text"]:
                count, decimals, back = own.written(text.as_py())
                n.append(count)
                ids.append(hashlib.sha256(decimals).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        digests, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, `ids` (array of int, the end id last) and `decoded` text."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for part in common.slices(batches):  # ids take more room than text
            flat, ends, decoded = [], [0], []
            for text in part["text"]:
                n, decimals, back = own.written(text.as_py())
                flat.append(np.fromstring(decimals.decode(), dtype=np.int32, sep=" "))
                ends.append(ends[-1] + n)
                decoded.append(back.decode("utf-8", "replace"))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
            yield pa.RecordBatch.from_arrays([part["doc_id"], ids, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        encoded, f"doc_id {kind}, ids array<int>, decoded string"
    )
