"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens and accepts a sequence exactly if it is what the merges make of its bytes. A state is the
last token read. Compilation starts from the one-state machine whose arcs are the 256 bytes and adds one gadget for
each merge, in merge order: the gadget of ``(a, b)`` puts an arc ``ab`` beside each path ``a b`` that is left, and
takes the arc ``b`` after ``a`` away. Whether an arc is left after a state follows from the gadgets alone, so
``Automaton.arc`` unwinds the gadgets of two tokens on first use and keeps the answer in a bounded table instead of
storing all 50,000 x 50,000 arcs. Each word has one accepted path; the encoder walks to it by the
longest arcs first and never returns to an end that proved dead. Decoding emits the labels of the arcs.

Edge cases: a null text encodes as an empty one; special tokens that stand in a
text are read as themselves; a text is encoded whole, in time linear in its length; rows are independent, so repeated
rows, empty tables and extra columns need no care.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.shared import fresh

#: Fixed value: the word pattern of byte-level vocabularies with a leading space.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file, to its byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class Automaton:
    """The compiled automaton of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, table_size: int = 1 << 18, words: int = 1 << 18) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids = {w: i for w, i in spec["model"]["vocab"].items() if w not in self.special}
        self.labels = {i: bytes(letters[c] for c in w) for w, i in ids.items()} | {i: w.encode() for w, i in self.special.items()}
        self.table: dict[int, bool] = {}
        self.paths: dict[str, list[int]] = {}
        self.table_size, self.words = table_size, words
        self.gadget: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.token = {self.labels[i]: i for i in ids.values() if len(self.labels[i]) == 1}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self._add(ids[a], ids[b], ids[a + b], rank)
        # A table of bytes finds the arcs that begin at a place: node and byte to node, and the arc that ends at a node.
        self.step: dict[int, int] = {}
        self.ends = [-1]
        for label, t in self.token.items():
            node = 0
            for byte in label:
                after = self.step.get(node << 8 | byte)
                if after is None:
                    after = self.step[node << 8 | byte] = len(self.ends)
                    self.ends.append(-1)
                node = after
            self.ends[node] = t
        self.size = {t: len(self.labels[t]) for t in self.token.values()}
        #: To an arc, the longest arc that it begins with.
        self.shorter = {t: next((self.token[x[:k]] for k in range(len(x) - 1, 0, -1) if x[:k] in self.token), -1) for x, t in self.token.items()}
        self.word = regex.compile(WORD)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _add(self, a: int, b: int, made: int, rank: int) -> None:
        """One gadget. The arc is new only where both parts are arcs and their path has outlived the gadgets so far."""
        la, lb = self.labels[a], self.labels[b]
        if self.token.get(la) == a and self.token.get(lb) == b and la + lb not in self.token and self._unwind(a, b, rank):
            self.parts[made], self.rank[made] = (a, b), rank
            self.token[la + lb] = made
        self.gadget.setdefault((a, b), rank)

    def _unwind(self, state: int, token: int, before: int) -> bool:
        """Take gadgets back, the last first; the path is gone if one of rank under ``before`` joins the tokens that
        touch, at a time when neither has yet become part of a longer one."""
        while True:
            if self.gadget.get((state, token), before) < before:
                return False
            left, right = self.rank.get(state, -1), self.rank.get(token, -1)
            if left < 0 and right < 0:
                return True
            if left > right:
                before, state = left, self.parts[state][1]
            else:  # of two equal tokens the left one is made first
                before, token = right + 1, self.parts[token][0]

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow ``state`` once all gadgets are in."""
        key = state << 24 | token
        left = self.table.get(key)
        if left is None:
            if len(self.table) >= self.table_size:
                self.table.clear()
            left = self.table[key] = self._unwind(state, token, len(self.gadget) + 1)
        return left

    def path(self, word: bytes) -> list[int]:
        """The accepted path over the bytes of one word."""
        if (whole := self.token.get(word)) is not None:
            return [whole]
        n, at, arc, step, ends, shorter, size = len(word), 0, self.arc, self.step, self.ends, self.shorter, self.size
        out: list[int] = []
        dead: set[int] = set()  # a prefix has one accepted path, so an end that leads nowhere is never tried again
        t = -2
        while at < n:
            if t == -2:  # the longest arc from here
                node, i, t = 0, at, -1
                while i < n:
                    node = step.get(node << 8 | word[i], 0)
                    if not node:
                        break
                    i += 1
                    if ends[node] >= 0:
                        t = ends[node]
            while t >= 0 and (at + size[t] in dead or out and not arc(out[-1], t)):
                t = shorter[t]
            if t >= 0:
                out.append(t)
                at += size[t]
                t = -2
            else:
                dead.add(at)
                t = out.pop()
                at -= size[t]
                t = shorter[t]
        return out

    def encode(self, text: str) -> list[int]:
        if self.cut and any(x in text for x in self.special):
            return [i for part in self.cut.split(text) for i in ([self.special[part]] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        paths, out = self.paths, []
        for word in self.word.findall(text):
            p = paths.get(word)
            if p is None:
                p = self.path(word.encode())
                if len(word) <= 64:
                    if len(paths) >= self.words:
                        paths.clear()
                    paths[word] = p
            out += p
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def compiled(path: str) -> Automaton:
    return Automaton(path)


def coder(path: str):
    """A function from a text column to a struct of its ids, ``array<int>``, and of the text that they decode to;
    ``path`` is a vocabulary file that executors can read. One function, so that a task holds one automaton."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = compiled(path)
        for texts in batches:
            flat, ends, back = array("i"), [0], []
            for x in texts:
                ids = automaton.encode(x.as_py() or "")
                flat.extend(ids)
                ends.append(len(flat))
                back.append(automaton.decode(ids))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))
            yield pa.StructArray.from_arrays([lists, pa.array(back, pa.string())], ["ids", "decoded"])

    return code


def tokenize(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the columns ``ids`` (array<int>) and ``decoded`` (string)."""
    coded = fresh(docs, "_coded")
    out = docs.withColumn(coded, coder(path)(F.col(f"`{text}`").cast("string")))
    return out.withColumns({ids: F.col(f"{coded}.ids"), decoded: F.col(f"{coded}.decoded")}).drop(coded)


def digests(ids: Column, decoded: Column) -> dict[str, Column]:
    return {
        "n_tokens": F.size(ids).cast("long"),
        "ids_sha256": F.sha2(F.array_join(ids.cast("array<string>"), ","), 256),
        "decoded_sha256": F.sha2(decoded, 256),
    }
